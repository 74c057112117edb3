"""WARC archives and transaction assembly (operator 10).

Method: a capture is written as a response (or revisit) record, with a request
and a metadata record that name it in WARC-Concurrent-To.  Reading gives one
row per record; records are joined through the concurrent-to identifiers, and
one nested row per capture comes out.

Payloads are compared by SHA-1 before writing: the smallest page_id of equal
payloads is the response, others are revisits that refer to it.
Archives are gzip files (one member per record) that the tasks write to the
shared folder through ``pyarrow.fs``.  A task gives back the files it finished;
files of lost or repeated attempts are never in that list and so never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shared_path, written

#: Payload bytes after which a task starts its next archive, and the smallest
#: payload that may be a revisit.
ARCHIVE_BYTES, LEAST_REVISIT = 64 << 20, 0
#: Shares of the captures that refer to one response.
SALTS = 32
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URLs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """``file:/x`` is how Hadoop spells ``file:///x``."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else "file://" + uri)


def record_id(kind: str, page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind}:{page_id}:{digest}')}>"


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=4, mtime=0) as member:
        member.write(raw)
    return out.getvalue()


def capture_records(page_id, url: str | None, payload: bytes, digest: str, first) -> Iterator[bytes]:
    """The three records of a capture."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url or "about:blank")
    main = record_id("capture", page_id, digest)
    common = {"WARC-Date": DATE, "WARC-Target-URI": url}
    revisit = first is not None and first != page_id and len(payload) >= LEAST_REVISIT
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    own = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": main, **common, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
    if revisit:
        own["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        own["WARC-Refers-To"] = record_id("capture", first, digest)
    yield record(own, head if revisit else head + payload)
    parts = urlsplit(url) if "://" in url else None
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "") if parts else "/"
    ask = f"GET {path} HTTP/1.1\r\nHost: {parts.netloc if parts else ''}\r\n\r\n".encode()
    yield record({"WARC-Type": "request", "WARC-Record-ID": record_id("request", page_id, digest), **common, "WARC-Concurrent-To": main, "Content-Type": "application/http;msgtype=request"}, ask)
    note = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    yield record({"WARC-Type": "metadata", "WARC-Record-ID": record_id("metadata", page_id, digest), **common, "WARC-Concurrent-To": main, "Content-Type": "application/warc-fields"}, note)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages; gives the table ``path, n_records`` of the archives."""
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    hashed = plain.withColumn("sha1", F.sha1("payload"))
    firsts = hashed.select("page_id", "sha1").groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, size, count = None, None, 0, 0
        done: list[tuple[str, int]] = []

        def close():
            nonlocal out, size, count
            if out is not None:
                out.close()
                done[-1] = (done[-1][0], count)
            out, size, count = None, 0, 0

        for batch in batches:
            for page_id, url, body, sha1, first in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    files, base = filesystem(folder)
                    files.create_dir(base, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    done.append((f"{folder}/{name}", 0))
                    out.write(record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                for raw in capture_records(page_id, url, body, digest, first):
                    out.write(raw)
                    count += 1
                size += len(body)
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"])

    joined = hashed.join(firsts, "sha1", "left").select("page_id", "url", "payload", "sha1", "first")
    return written(joined.mapInArrow(run, "path string, n_records long"), "warc-files")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=stream, mode="rb"), 1 << 20)
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := data.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = data.read(int(headers.get("content-length", 0)))
        if len(block) != int(headers.get("content-length", 0)):
            raise ValueError("archive ends inside a record")
        yield headers, block


RECORDS = "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, payload_bytes long, payload_digest string, page_id long"


def read_archives(files: DataFrame) -> DataFrame:
    """One row per record of the archives in ``path``.  Payloads are measured
    and checked against their digest; archives are streamed, each by a task of
    its own."""

    def work(batch):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        out = {n: [] for n in names}
        for path in batch["path"]:
            source, name = filesystem(path)
            with source.open_input_stream(name, compression=None) as stream:
                for head, block in parse(stream):
                    kind, size, page = head.get("warc-type"), None, None
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        size = len(payload)
                        if digest != base32_digest(payload):
                            raise ValueError(f"payload of {head['warc-record-id']} is damaged")
                    elif kind == "metadata" and (found := re.search(rb"^page-id: (-?\d+)", block, re.M)):
                        page = int(found[1])
                    values = (head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"), size, digest, page)
                    for n, v in zip(names, values):
                        out[n].append(v)
        return {n: pa.array(v, pa.int64() if n in ("payload_bytes", "page_id") else pa.string()) for n, v in out.items()}

    # Round robin over as many tasks as there are files: hashes of so few paths
    # would meet, and a partitioning by key may be coalesced.
    return map_batches(files.select("path").repartition(max(1, files.count())), RECORDS, work)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, copies, response, request,
    metadata``.  Requests and metadata meet their response through
    concurrent-to; of several the one with the least id is kept.  ``copies``
    counts equal records of one identifier (repeated pages)."""
    side = lambda kind: F.min(F.when(F.col("record_type") == kind, F.struct("record_id", "target_uri", "page_id")))
    answer = F.col("record_type").isin("response", "revisit")
    main = F.struct("record_type", "payload_bytes", "payload_digest", "refers_to", "target_uri")
    return (
        records.where(answer | F.col("record_type").isin("request", "metadata"))
        .withColumn("capture_id", F.when(answer, F.col("record_id")).otherwise(F.col("concurrent_to")))
        .groupBy("capture_id")
        .agg(
            F.count(F.when(answer, 1)).alias("copies"),
            F.min(F.when(answer, main)).alias("response"),
            side("request").alias("request"),
            side("metadata").alias("metadata"),
        )
        .where("copies > 0")
    )


def page_rows(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url``
    per capture; a revisit has the size of the response it refers to."""
    flat = captures.select("capture_id", "copies", "response.*", F.col("metadata.page_id").alias("page_id"))
    asked = flat.where("refers_to IS NOT NULL").select("refers_to").distinct()
    target = flat.where("record_type = 'response'").select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"))
    # One popular payload may be what a third of all captures refer to: its
    # revisits are dealt to SALTS shares, and responses that are referred to at
    # all are copied to each.  Sizes are unknown to Spark here (its only source
    # is the list of files), so the joins are told to shuffle.
    target = target.join(asked.hint("merge"), "refers_to", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = flat.withColumn("salt", F.pmod(F.xxhash64("capture_id"), F.lit(SALTS)).cast("int"))
    return (
        dealt.join(target.hint("merge"), ["refers_to", "salt"], "left")
        .select(
            "page_id",
            F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            F.col("to_page").alias("refers_to"),
            F.col("target_uri").alias("url"),
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back.

    Null pages have the empty payload; null urls become ``about:blank``; a
    repeated row gives another capture of the same identifier and comes back
    as often as it was written; among payloads without any page_id all are
    responses.  Extra columns are ignored; an empty table gives no rows.
    """
    files = write_archives(pages, shared_path(pages.sparkSession, "warc"))
    # Records (without payloads) are written once: both sides of the join start
    # from them, and no archive is parsed twice.
    return page_rows(written(assemble(read_archives(files)), "captures"))


def base32_sql(hex_digest: str) -> str:
    """DuckDB: bare base32 of a 40-digit hex string."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digit = f"((('0x' || substr({hex_digest}, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)"
    return f"array_to_string(list_transform(range(32), lambda i: substr('{alphabet}', {digit} + 1, 1)), '')"


ORACLE = f"""
WITH hashed AS (
  SELECT page_id, coalesce(url, 'about:blank') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), firsts AS (SELECT sha, min(page_id) AS first FROM hashed GROUP BY sha)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {base32_sql("sha")} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM hashed JOIN firsts USING (sha)
"""
