"""Citations in free text, checked against a closed index of authorities.

The index, the allowed vocabulary per form and the link statuses are tables;
finding the spans is the only step that leaves the JVM, since Spark's regex
functions give no offsets.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.functions.text import present

PLACEHOLDER = r"\[\[REF:\s*([^\]]+?)\s*\]\]"
URL = r"https?://[^\s)>\]\"'}]+"
# Hosts that stand for no real site.
PLACEHOLDER_HOSTS = (
    "example.com", "example.org", "example.net", "example.edu", "example", "test.com", "foo.com",
    "foo.bar", "domain.com", "yoursite.com", "localhost",
)
HIT = "doc_id bigint, raw string, cite string, kind string, start int, end int, in_placeholder boolean"


class Family(NamedTuple):
    """One citation form.  ``cite`` is put together from pieces over the groups
    of ``pattern``; a piece whose group is missing is left out.  With ``each``,
    every match of it inside is a citation of its own.  Texts without
    ``needs``, a cheap pattern that any match contains, are not searched."""

    pattern: str
    cite: tuple[str, ...]
    kind: str
    needs: str = ""
    each: str | None = None


def families(home: str) -> tuple[Family, ...]:
    """Citation forms in priority order; bare sections belong to title ``home``."""
    title = re.escape(home)
    own = (home + " §{0}",)
    # The printed forms of statute, neutral and reporter citations.
    titled = rf"(?i)\b{title}\b\s*(?:M\.?\s?R\.?\s?S\.?(?:A\.?)?)?[,\s]*(?:§|sec(?:tion|\.)?)\s*(\d+-\d+)(?:\([0-9A-Za-z]+\))?"
    reverse = rf"(?i)(?:§|sec(?:tion|\.)?)\s*(\d+-\d+)(?:\([0-9A-Za-z]+\))?\s+of\s+(?:Title\s+)?{title}\b"
    neutral = r"\b(\d{4})\s+ME\s+(\d+)\b"
    reporter = r"\b(\d+)\s+A\.?\s?([23])d\s+(\d+)\b"
    other_title = r"\b(\d+(?:-[A-Z])?)\s*M\.?\s?R\.?\s?S\.?(?:A\.?)?\s*(?:§\s*(\d+(?:-[A-Z])?)(?:\([0-9A-Za-z]+\))?)?"
    section_list = r"§§?\s*\d+-\d+(?:\s*(?:,|;|&|and)\s*\d+-\d+)+"
    bare = r"§\s*(\d+-\d+)(?:\([0-9A-Za-z]+\))?"
    return (
        Family(titled, own, "statute", title),
        Family(reverse, own, "statute", title),
        Family(neutral, ("{0} ME {1}",), "case", "ME"),
        Family(reporter, ("{0} A.{1}d {2}",), "case", "[23]d"),
        Family(rf"(?!\b{title}\b)" + other_title, ("{0} M.R.S.", " §{1}"), "crossref", r"R\.?\s?S"),
        Family(section_list, own, "statute", "§", r"(\d+-\d+)"),
        Family(bare, own, "statute", "§"),
    )


def name_variants(names: dict[str, str]) -> dict[str, str]:
    """Case names with their citation; "In re X" is known as "X" as well."""
    short = {re.sub(r"(?i)^in re\s+", "", name): cite for name, cite in names.items()}
    return {n: c for n, c in {**short, **names}.items() if n}


def scan_mentions(docs: DataFrame, forms: Sequence[Family], names: dict[str, str] | None = None) -> DataFrame:
    """Citation spans of whole texts: raw, cite, kind, start, end.

    Families are tried in order; a hit overlapping an earlier one is dropped.
    ``names`` maps known case names to their citation.
    """
    compiled = [
        (re.compile(f.pattern), f.cite, f.kind, re.compile(f.needs, re.I), re.compile(f.each) if f.each else None) for f in forms
    ]
    compiled += [
        (re.compile(re.escape(n), re.I), (c.replace("{", "{{").replace("}", "}}"),), "case", re.compile(""), None)
        for n, c in sorted(name_variants(names or {}).items())
    ]
    placeholder = re.compile(PLACEHOLDER)

    def cited(pieces: tuple[str, ...], groups: tuple) -> str:
        holes = [[int(i) for i in re.findall(r"\{(\d)\}", piece)] for piece in pieces]
        return "".join(p.format(*groups) for p, need in zip(pieces, holes) if all(groups[i] is not None for i in need))

    def hits(text: str) -> Iterator[tuple]:
        refs = [m.span() for m in placeholder.finditer(text)]
        starts: list[int] = []  # of the spans taken, in order; ends beside them
        ends: list[int] = []
        for regex, pieces, kind, needs, each in compiled:
            if not needs.search(text):
                continue
            for outer in regex.finditer(text):
                for m in each.finditer(text, *outer.span()) if each else (outer,):
                    a, b = m.span()
                    at = bisect_left(starts, b)  # those before start left of b
                    if at and ends[at - 1] > a:
                        continue
                    starts.insert(at, a)
                    ends.insert(at, b)
                    k = bisect_right(refs, (a, len(text))) - 1
                    inside = k >= 0 and b <= refs[k][1]
                    yield m.group(0).strip(), cited(pieces, m.groups()), kind, a, b, inside

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, *h) for d, text in zip(batch["doc_id"], batch["text"]) for h in hits(text)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in HIT.split(", ")])

    return docs.select("doc_id", V.fold_lookalikes(F.col("text")).alias("text")).mapInPandas(scan, HIT)


def expand_section_lists(docs: DataFrame, home: str) -> DataFrame:
    """Every section of lists such as "§§ 5-301 and 9-999", without offsets."""
    text = V.fold_lookalikes(F.col("text"))
    lists = F.regexp_extract_all(text, F.lit(r"§§?\s*\d+-\d+(?:\s*(?:,|;|&|and)\s*\d+-\d+)+"), 0)
    return (
        docs.select("doc_id", F.explode(lists).alias("l"))
        .select("doc_id", F.explode(F.regexp_extract_all("l", F.lit(r"\d+-\d+"), 0)).alias("s"))
        .select("doc_id", F.concat(F.lit(home + " §"), "s").alias("cite"))
    )


def closed_index_lookup(mentions: DataFrame, authorities: DataFrame) -> DataFrame:
    """Is the cite known at all."""
    known = authorities.select("cite", F.lit(True).alias("_k")).distinct()
    return mentions.join(known, "cite", "left").withColumn("resolves", F.coalesce("_k", F.lit(False))).drop("_k")


def resolve_mentions(mentions: DataFrame, doc_forms: DataFrame, authorities: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Is the cite known, and does the document's form allow it (null for a
    document without a form)."""
    v = vocabulary.select("form_id", "cite", F.lit(True).alias("_v")).distinct()
    return (
        closed_index_lookup(mentions, authorities)
        .join(doc_forms, "doc_id", "left")
        .join(v, ["form_id", "cite"], "left")
        .withColumn("in_vocab", F.when(F.col("form_id").isNotNull(), F.coalesce("_v", F.lit(False))))
        .drop("_v")
    )


def used_authorities(sections: Sequence[DataFrame], authorities: DataFrame) -> DataFrame:
    """Distinct cites across sections that resolve."""
    out = sections[0].select("cite")
    for s in sections[1:]:
        out = out.unionByName(s.select("cite"))
    return out.distinct().join(authorities.select("cite"), "cite", "left_semi")


def placeholder_refs(docs: DataFrame) -> DataFrame:
    """Keys of ``[[REF: key]]`` in order of first use."""
    keys = F.array_distinct(F.regexp_extract_all("text", F.lit(PLACEHOLDER), 1))
    return docs.select("doc_id", F.posexplode(keys).alias("pos", "key"))


def substitute_refs(docs: DataFrame, vocabulary: DataFrame, authorities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Placeholders replaced by authority text, and one status per key:
    resolved, unresolved, invented or dead_link.

    ``docs``: doc_id, form_id, text.  ``authorities``: key, cite, title, text,
    dead_link.
    """
    pieces = F.regexp_extract_all("text", F.lit(rf"(?s){PLACEHOLDER}|.+?(?=\[\[REF:)|.+"), 0)
    cut = docs.select("doc_id", "form_id", F.posexplode(pieces).alias("pos", "piece")).withColumn(
        "key", F.nullif(F.regexp_extract("piece", f"^{PLACEHOLDER}$", 1), F.lit(""))
    )
    allowed = vocabulary.select("form_id", "key", F.lit(True).alias("_ok")).distinct()
    status = (
        F.when(F.col("_ok").isNull(), "invented")
        .when(present(F.coalesce("auth_text", F.lit(""))), "resolved")
        .when(F.coalesce("dead_link", F.lit(False)), "dead_link")
        .otherwise("unresolved")
    )
    auth = authorities.select("key", "cite", "title", F.col("text").alias("auth_text"), "dead_link")
    # Text between placeholders has no key to look up; joined by it, all text
    # would go to one task.
    marked = (
        cut.where("key IS NOT NULL")
        .join(allowed, ["form_id", "key"], "left")
        .join(auth, "key", "left")
        .withColumn("status", status)
    )
    name = F.coalesce("cite", "key")
    block = F.concat(
        F.lit("\n=== AUTHORITY ["), name, F.lit("] ===\n"),
        F.when(present(F.col("title")), F.concat(F.lit("Title: "), "title", F.lit("\n"))).otherwise(""),
        F.trim("auth_text"), F.lit("\n=== END ["), name, F.lit("] ===\n"),
    )
    tag = lambda word: F.concat(F.lit(f"[[{word}: "), "key", F.lit("]]"))
    shown = (
        F.when(F.col("status") == "resolved", block)
        .when(F.col("status") == "dead_link", tag("DEAD LINK"))
        .when(F.col("status") == "unresolved", tag("UNRESOLVED"))
        .otherwise(tag("INVENTED"))
    )
    between = cut.where("key IS NULL").select("doc_id", "pos", F.col("piece").alias("s"))
    text = between.unionByName(marked.select("doc_id", "pos", shown.alias("s"))).groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda p: p["s"]), "").alias("text")
    )
    statuses = marked.groupBy("doc_id", "key").agg(F.max("status").alias("status"), F.count("*").alias("n"))
    return text, statuses


def scan_urls(docs: DataFrame) -> DataFrame:
    """Distinct URLs of a text, trailing punctuation removed."""
    found = F.regexp_extract_all(V.fold_lookalikes(F.col("text")), F.lit(URL), 0)
    return docs.select("doc_id", F.explode(F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"[.,);\]'\"]+$", "")))).alias("url"))


def classify_urls(urls: DataFrame, known: DataFrame, governed_hosts: Sequence[str]) -> DataFrame:
    """placeholder, known, fabricated (a governed host's page that is not in
    the index) or unknown."""
    host = F.lower(F.substring_index(F.regexp_replace("url", "^https?://", ""), "/", 1))
    fake = host.isin(list(PLACEHOLDER_HOSTS)) | host.rlike(r"\.(test|example|invalid)$")
    index = known.select("url", F.lit(True).alias("_k")).distinct()
    klass = (
        F.when(fake, "placeholder")
        .when(F.col("_k"), "known")
        .when(host.isin(list(governed_hosts)), "fabricated")
        .otherwise("unknown")
    )
    return urls.join(index, "url", "left").select("doc_id", "url", klass.alias("class"))


#: Bucket and what is said about it, in the order of a guard's reasons.
REASONS = (
    ("leaked", "citations written outside the protocol"),
    ("unresolvable", "citations not in the trusted index"),
    ("out_of_vocab", "citations outside the form's scope"),
    ("bad_urls", "made-up URLs"),
    ("invented_refs", "placeholders that name no authority"),
    ("dead_refs", "authorities whose link is dead"),
    ("dead_urls", "URLs that are dead"),
    ("failed_verdicts", "authorities that failed review"),
)


def bucket_report(
    resolved: DataFrame,
    urls: DataFrame,
    docs: DataFrame,
    statuses: DataFrame | None = None,
    audit: DataFrame | None = None,
    verdicts: DataFrame | None = None,
) -> DataFrame:
    """One row per document, clean ones too: cites leaked outside placeholders,
    unresolvable ones, ones out of vocabulary, made-up and dead URLs, invented
    and dead placeholders, and authorities that failed review.

    ``statuses`` comes from ``substitute_refs``, ``audit`` from ``link_audit``
    and ``verdicts`` from ``quote_grounding``.
    """
    listed = lambda name, when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col(name)))), ",")
    parts = [
        resolved.join(docs.select("doc_id", F.col("text").rlike(PLACEHOLDER).alias("uses_protocol")), "doc_id")
        .groupBy("doc_id")
        .agg(
            listed("cite", F.col("uses_protocol") & ~F.col("in_placeholder")).alias("leaked"),
            listed("cite", ~F.col("resolves")).alias("unresolvable"),
            listed("cite", F.col("resolves") & ~F.col("in_vocab")).alias("out_of_vocab"),
        )
    ]
    fake = F.col("class").isin("placeholder", "fabricated")
    dead = F.lit(False)
    if audit is not None:
        urls = urls.join(audit.select("url", "status"), "url", "left")
        dead = F.col("status") == "dead"
    parts.append(urls.groupBy("doc_id").agg(listed("url", fake).alias("bad_urls"), listed("url", dead).alias("dead_urls")))
    if statuses is not None:
        of = lambda status: listed("key", F.col("status") == status)
        parts.append(statuses.groupBy("doc_id").agg(of("invented").alias("invented_refs"), of("dead_link").alias("dead_refs")))
    if verdicts is not None:
        parts.append(verdicts.groupBy("doc_id").agg(listed("cite", F.col("verdict") == "fail").alias("failed_verdicts")))
    out = docs.select("doc_id").distinct()
    for part in parts:
        out = out.join(part, "doc_id", "left")
    have = set(out.columns)
    return out.select("doc_id", *[(F.coalesce(c, F.lit("")) if c in have else F.lit("")).alias(c) for c, _ in REASONS])


def guard_decision(buckets: DataFrame) -> DataFrame:
    """Block flag and reason text per document."""
    said = F.concat_ws("; ", *[F.when(F.col(c) != "", F.concat(F.lit(f"{why}: "), c)) for c, why in REASONS])
    return buckets.select("doc_id", (said != "").alias("block"), F.when(said != "", F.concat(F.lit("Blocked: "), said, F.lit("."))).otherwise("").alias("reason"))


def quote_grounding(verdicts: DataFrame, cited: DataFrame, authorities: DataFrame) -> DataFrame:
    """Verdicts with their quotes checked against the authority text.

    A pass whose quote is not in the text becomes unclear; cited authorities
    without a verdict are added as unreviewed.
    """
    auth = authorities.select("cite", F.col("text").alias("auth_text"))
    key = ["doc_id", "cite"]
    j = (
        verdicts.withColumn("_has", F.lit(True))
        .join(cited.select(*key).distinct().withColumn("_cited", F.lit(True)), key, "full")
        .join(auth, "cite", "left")
    )
    quote = V.norm(F.col("quote"))
    grounded = (quote == "") | F.col("auth_text").isNull() | V.norm(F.col("auth_text")).contains(quote)
    given = F.when(F.col("verdict").isin("pass", "fail", "unclear"), F.col("verdict")).otherwise("unclear")
    has = F.coalesce("_has", F.lit(False))
    return j.select(
        *key,
        F.when(~has, "unclear").when(~grounded & (given == "pass"), "unclear").otherwise(given).alias("verdict"),
        (has & grounded).alias("grounded"),
        (~has).alias("unreviewed"),
    )


def link_uses(links: DataFrame, status: DataFrame) -> DataFrame:
    """Long form of the audit: url, cite, n_uses and the url's status."""
    uses = links.groupBy("url", "cite").agg(F.count("*").alias("n_uses"))
    s = status.select("url", V.link_status(F.col("http_code")).alias("status"))
    return uses.join(s, "url", "left").withColumn("status", F.coalesce("status", F.lit("inconclusive")))


def link_audit(links: DataFrame, status: DataFrame) -> DataFrame:
    """Each distinct URL with its status from a crawler's table and a list of the
    cites that use it (``link_uses`` is the long table); links never fetched are
    inconclusive."""
    uses = links.groupBy("url").agg(
        F.count("*").alias("n_uses"), F.array_join(F.array_sort(F.collect_set("cite")), ",").alias("cites")
    )
    s = status.select("url", V.link_status(F.col("http_code")).alias("status"))
    return uses.join(s, "url", "left").withColumn("status", F.coalesce("status", F.lit("inconclusive")))


def link_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count("*").alias("n"), F.sum("n_uses").alias("n_uses"))
