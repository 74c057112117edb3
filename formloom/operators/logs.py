"""Work logs folded to item states, and hash-chained logs built and checked."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.functions.text import present

MAX_ATTEMPTS = 3
GENESIS = "0" * 64
ACTIONS = ("begin", "ok", "error", "reset", "retry")


def run_state(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """State of every item after its whole log.

    ``log``: item, ts, event_id, action.  ``begin`` counts an attempt, ``ok``
    ends in DONE, ``error`` in FAILED or, from the third attempt on, DEAD;
    ``retry`` reopens a failed item and ``reset`` starts over.  The fold needs
    only the last reset, the attempts after it and the last decisive action, so
    it is two combinable aggregations however long one item's log is.
    """
    at = F.struct("ts", "event_id")
    # counts of begins are kept per item; begins before the last reset drop out
    resets = log.groupBy("item").agg(F.max(F.when(F.col("action") == "reset", at)).alias("_reset"))
    since = log.join(resets, "item").where(F.col("_reset").isNull() | (at >= F.col("_reset")))
    decisive = F.col("action").isin("begin", "ok", "error", "reset")
    folded = since.groupBy("item").agg(
        F.count_if(F.col("action") == "begin").alias("attempts"),
        F.max(F.when(decisive, F.struct("ts", "event_id", "action"))).alias("_last"),
        F.max(F.when(F.col("action") == "retry", at)).alias("_retry"),
    )
    last = F.col("_last.action")
    ended = F.when(F.col("attempts") >= max_attempts, "DEAD").otherwise("FAILED")
    status = (
        F.when(last == "begin", "IN_PROGRESS").when(last == "ok", "DONE").when(last == "error", ended).otherwise("PENDING")
    )
    retried = F.col("_retry") > F.struct(F.col("_last.ts").alias("ts"), F.col("_last.event_id").alias("event_id"))
    return folded.select(
        "item",
        F.when((status == "FAILED") & F.coalesce(retried, F.lit(False)), "PENDING").otherwise(status).alias("status"),
        "attempts",
    )


def status_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("status").agg(F.count("*").alias("n"))


def queue_views(states: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pending items, dead items, and one repeatable random pending item."""
    pending = states.where("status = 'PENDING'")
    pick = pending.orderBy(V.seeded_order(F.col("item"), seed), "item").limit(1)
    return pending, states.where("status = 'DEAD'"), pick


CHAIN = "log_key bigint, seq bigint, payload string, prev_hash string, line_hash string"


def line_text(seq, prev_hash: str, payload: str) -> str:
    return f"{seq}|{prev_hash}|{payload}"


def append_chain(entries: DataFrame) -> DataFrame:
    """Chain the entries of every log: each line holds the hash of the line
    before it.

    ``entries``: log_key, seq (from 0), payload.  A hash chain is sequential by
    nature; rows are sorted within partitions and streamed past a running hash,
    so no log is ever held in memory.
    """

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, last = None, GENESIS
        for batch in batches:
            prev, own = [], []
            for key, seq, payload in zip(batch["log_key"], batch["seq"], batch["payload"]):
                if key != current:
                    current, last = key, GENESIS
                prev.append(last)
                last = hashlib.sha256(line_text(seq, last, payload).encode()).hexdigest()
                own.append(last)
            yield batch.assign(prev_hash=prev, line_hash=own)

    ordered = entries.select("log_key", "seq", "payload").repartition("log_key").sortWithinPartitions("log_key", "seq")
    return ordered.mapInPandas(link, CHAIN)


def verify_chain(log: DataFrame) -> DataFrame:
    """Every log line with what is wrong with it, if anything.

    ``log``: log_key, seq, payload, prev_hash, receipt_hash.  A line is checked
    against its predecessor by a join on (key, seq), so one long log is checked
    by many tasks.
    """
    line = F.concat_ws("|", F.col("seq").cast("string"), "prev_hash", "payload")
    before = log.select("log_key", (F.col("seq") + 1).alias("seq"), V.digest(line).alias("expected"))
    j = log.join(before, ["log_key", "seq"], "left")
    broken = F.coalesce("expected", F.lit(GENESIS)) != F.col("prev_hash")
    altered = V.digest(F.col("payload")) != F.col("receipt_hash")
    problems = F.concat_ws(",", F.when(broken, "chain_break"), F.when(altered, "receipt_mismatch"))
    return j.select("log_key", "seq", problems.alias("problems"))


def signature(key: bytes):
    """Keyed HMAC-SHA256 (RFC 2104) of a text column, from built-in digests."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))

    def sign(text: str | Column) -> Column:
        text = F.col(text) if isinstance(text, str) else text
        message = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
        return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)

    return sign


def attest(results: DataFrame) -> DataFrame:
    """One receipt per inspected text.

    ``results``: doc_id, text, leaked, unresolvable, out_of_vocab, bad_urls,
    nonce, at — nonce and time are inputs, so a rerun gives the same receipt.
    """
    findings = {c: F.col(c) for c in ("leaked", "unresolvable", "out_of_vocab", "bad_urls")}
    review = present(F.col("leaked")) | present(F.col("unresolvable")) | present(F.col("bad_urls"))
    staged = results.select(
        "doc_id",
        V.digest(F.col("text")).alias("input_sha256"),
        V.digest(V.canonical_json(**findings)).alias("verdict_digest"),
        review.alias("needs_review"),
        "nonce",
        "at",
    )
    body = V.canonical_json(**{c: F.col(c) for c in ("input_sha256", "verdict_digest", "needs_review", "nonce", "at")})
    return staged.withColumn("receipt_hash", V.digest(body))


def last_message(messages: DataFrame, role: str = "assistant") -> DataFrame:
    """The last message of a role in each conversation."""
    return messages.where(F.col("role") == role).groupBy("conv_id").agg(F.max_by("text", "turn").alias("text"), F.max("turn").alias("turn"))


def findings_rate(findings: DataFrame, every: str = "1 hour") -> DataFrame:
    """Findings per time window and code (the window is our addition)."""
    return findings.groupBy(F.window("ts", every).alias("w"), "code").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "code", "n"
    )
