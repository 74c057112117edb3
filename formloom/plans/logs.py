"""Work logs, hash chains, receipts and their streams over the given events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.operators import citations, logs, reports
from formloom.operators.routing import form_routes
from formloom.plans import citations as cited
from formloom.plans.registry import query
from formloom.plans.routing import SCORED, case_events, catalogue
from formloom.sources.testdata import Tables
from formloom.streaming import jobs

ACTION = "CASE event_type WHEN 'click' THEN 'begin' WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'reset' ELSE 'retry' END"


def _as_log(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("item"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.expr(ACTION).alias("action"))


STATES = f"""WITH l AS (SELECT user_id AS item, (ts, event_id) AS o, {ACTION} AS action FROM events),
z AS (SELECT item, max(o) FILTER (action = 'reset') AS rs FROM l GROUP BY item),
s AS (SELECT l.item, count(*) FILTER (action = 'begin') AS attempts, arg_max(action, o) FILTER (action <> 'retry') AS last, max(o) FILTER (action <> 'retry') AS lo, max(o) FILTER (action = 'retry') AS ro
  FROM l JOIN z ON l.item = z.item WHERE rs IS NULL OR o >= rs GROUP BY l.item),
t AS (SELECT *, CASE last WHEN 'begin' THEN 'IN_PROGRESS' WHEN 'ok' THEN 'DONE' WHEN 'error' THEN CASE WHEN attempts >= 3 THEN 'DEAD' ELSE 'FAILED' END ELSE 'PENDING' END AS st FROM s),
states AS (SELECT item, CASE WHEN st = 'FAILED' AND ro > lo THEN 'PENDING' ELSE st END AS status, attempts FROM t)"""


@query(sql=f"{STATES} SELECT * FROM states")
def run_state(t: Tables):
    return logs.run_state(_as_log(t.raw("events")))


@query(sql=f"{STATES} SELECT status, count(*) AS n FROM states GROUP BY status")
def status_counts(t: Tables):
    return logs.status_counts(logs.run_state(_as_log(t.raw("events"))))


@query(
    sql=f"{STATES} SELECT 'pending' AS view, item FROM states WHERE status = 'PENDING' UNION ALL SELECT 'dead', item FROM states WHERE status = 'DEAD'",
)
def queue_views(t: Tables):
    pending, dead, _ = logs.queue_views(logs.run_state(_as_log(t.raw("events"))), seed=7)
    return pending.select(F.lit("pending").alias("view"), "item").unionByName(dead.select(F.lit("dead").alias("view"), "item"))


@query(sql=f"{STATES} SELECT * FROM states WHERE status = 'PENDING' ORDER BY sha256(item || '|7'), item LIMIT 1")
def queue_pick(t: Tables):
    return logs.queue_views(logs.run_state(_as_log(t.raw("events"))), seed=7)[2]


@query("stream_run_state", sql=f"{STATES} SELECT * FROM states")
def stream_run_state(t: Tables):
    stream = jobs.run_state(_as_log(jobs.table_stream(t.spark, t.folder, "events")))
    out = jobs.run_to_table(stream, jobs.run_folder(t.spark, "run_state"), "update")
    return reports.latest_by_key(out, ["item"], ["batch_no"]).select("item", "status", "attempts")


@query("stream_status_counts", sql=f"{STATES} SELECT status, count(*) AS n FROM states GROUP BY status")
def stream_status_counts(t: Tables):
    return logs.status_counts(stream_run_state(t))


def _entries(t: Tables) -> DataFrame:
    """Events as log entries; seq counts an item's events by id.

    Ranks are taken in slices of event ids, so one busy item is spread.
    """
    from formloom.operators.ranking import rank_in_groups

    e = t.raw("events").select(F.col("user_id").alias("log_key"), "event_id", F.concat_ws(":", F.col("event_id").cast("string"), "event_type").alias("payload"))
    ranked = rank_in_groups(e, ["log_key"], [F.col("event_id")], [F.floor(F.col("event_id") / 10000)], "rank")
    return ranked.select("log_key", (F.col("rank") - 1).alias("seq"), "payload")


CHAINED = """WITH e AS (SELECT user_id AS log_key, CAST(event_id AS VARCHAR) || ':' || event_type AS payload, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS seq FROM events),
g AS (SELECT log_key, list(payload ORDER BY seq) AS ps FROM e GROUP BY log_key),
f AS (SELECT log_key, ps, list_reduce(list_prepend([repeat('0', 64)], list_transform(ps, lambda p, i: [CAST(i - 1 AS VARCHAR), p])), lambda acc, x: list_append(acc, sha256(x[1] || '|' || acc[-1] || '|' || x[2]))) AS hs FROM g),
chain AS (SELECT log_key, unnest(range(len(ps))) AS seq, unnest(ps) AS payload, unnest(hs[1:len(ps)]) AS prev_hash, unnest(hs[2:]) AS line_hash FROM f)"""


@query(sql=f"{CHAINED} SELECT * FROM chain")
def append_chain(t: Tables):
    return logs.append_chain(_entries(t))


@query("stream_append_chain", sql=f"{CHAINED} SELECT * FROM chain")
def stream_append_chain(t: Tables):
    """The events come in order, so the watermark may follow them closely and
    every entry is linked by the end."""
    payload = F.concat_ws(":", F.col("event_id").cast("string"), "event_type").alias("payload")
    e = jobs.table_stream(t.spark, t.folder, "events").select(F.col("user_id").alias("log_key"), F.col("event_id").alias("order_id"), F.col("ts").cast("timestamp").alias("ts"), payload)
    return jobs.run_to_table(jobs.append_chain(e, late="0 seconds"), jobs.run_folder(t.spark, "append_chain"))


@query(
    sql=f"""{CHAINED}, bad AS (SELECT *, CAST(string_split(payload, ':')[1] AS BIGINT) % 500 = 0 AS hit FROM chain),
n AS (SELECT *, lag(hit) OVER (PARTITION BY log_key ORDER BY seq) AS before FROM bad)
SELECT log_key, seq, concat_ws(',', CASE WHEN before THEN 'chain_break' END, CASE WHEN hit THEN 'receipt_mismatch' END) AS problems FROM n""",
)
def verify_chain(t: Tables):
    """Every 500th event is altered after the chain was built."""
    chained = logs.append_chain(_entries(t)).withColumn("receipt_hash", V.digest(F.col("payload")))
    hit = F.substring_index("payload", ":", 1).cast("bigint") % 500 == 0
    tampered = chained.withColumn("payload", F.when(hit, F.concat("payload", F.lit("?"))).otherwise(F.col("payload")))
    return logs.verify_chain(tampered)


KEY = b"test key"
INNER, OUTER = ("".join(f"{b ^ pad:02x}" for b in KEY.ljust(64, b"\0")) for pad in (0x36, 0x5C))
ENTRIES = """e AS (SELECT user_id AS log_key, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS seq, event_id || ':' || event_type AS payload FROM events)"""


@query(sql=f"WITH {ENTRIES} SELECT log_key, seq, sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || encode(payload)))) AS signature FROM e")
def signatures(t: Tables):
    sign = logs.signature(KEY)
    return _entries(t).select("log_key", "seq", sign("payload").alias("signature"))


def _inspected(t: Tables) -> DataFrame:
    d = cited.docs(t)
    at = F.concat(F.lit("2024-01-01T00:00:"), F.lpad((F.col("doc_id") % 60).cast("string"), 2, "0"))
    return cited._buckets(t).join(d.select("doc_id", "text"), "doc_id").withColumns({"nonce": F.col("doc_id").cast("string"), "at": at})


@query(
    sql=f"""{cited.BUCKETS}, p AS (SELECT d.doc_id, text || chr(10) || list_extract([{', '.join("'" + x.replace("'", "''") + "'" for x, _ in cited.PLANTED)}], d.doc_id % {cited.KINDS} + 1) AS text, leaked, unresolvable, out_of_vocab, bad_urls FROM documents d JOIN bk ON d.doc_id = bk.doc_id)
SELECT doc_id, sha256(text) AS input_sha256, sha256('{{"bad_urls":"' || bad_urls || '","leaked":"' || leaked || '","out_of_vocab":"' || out_of_vocab || '","unresolvable":"' || unresolvable || '"}}') AS verdict_digest,
  leaked <> '' OR unresolvable <> '' OR bad_urls <> '' AS needs_review FROM p""",
)
def attest(t: Tables):
    return logs.attest(_inspected(t)).select("doc_id", "input_sha256", "verdict_digest", "needs_review")


def _messages(df: DataFrame) -> DataFrame:
    k = (F.col("conv_id") % cited.KINDS + 1).cast("int")
    plant = F.element_at(F.array(*[F.lit(x) for x, _ in cited.PLANTED]), k)
    return df.withColumn("text", F.concat_ws(" ", "text", plant))


GUARD = cited.DOCS.replace("FROM documents JOIN plant", "FROM (SELECT DISTINCT conv_id AS doc_id FROM conversations WHERE role = 'assistant') c JOIN plant")


@query(
    sql=f"""{GUARD}, a AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant'), b AS (SELECT doc_id, string_agg(DISTINCT cite, ',' ORDER BY cite) AS cites FROM r WHERE NOT resolves GROUP BY doc_id)
SELECT conv_id, b.doc_id IS NOT NULL AS block, coalesce(cites, '') AS unresolvable FROM a LEFT JOIN b ON a.conv_id = b.doc_id""",
)
def guard_conversations(t: Tables):
    """The last assistant message of each conversation, blocked or passed."""
    last = logs.last_message(_messages(t.raw("conversations"))).select(F.col("conv_id").alias("doc_id"), "text")
    found = citations.closed_index_lookup(citations.scan_mentions(last, citations.families(cited.HOME)), cited.authorities(t))
    bad = found.where("NOT resolves").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("cite")), ",").alias("unresolvable"))
    return last.select("doc_id").join(bad, "doc_id", "left").select(
        F.col("doc_id").alias("conv_id"), F.col("unresolvable").isNotNull().alias("block"), F.coalesce("unresolvable", F.lit("")).alias("unresolvable")
    )


@query("stream_guard", sql=f"{GUARD} SELECT DISTINCT r.doc_id AS conv_id, r.cite FROM r WHERE NOT resolves")
def stream_guard(t: Tables):
    stream = jobs.guard_messages(_messages(jobs.table_stream(t.spark, t.folder, "conversations")), citations.families(cited.HOME), cited.authorities(t))
    return jobs.run_to_table(stream, jobs.run_folder(t.spark, "guard")).distinct()


RATE = "SELECT date_trunc('hour', ts) AS window_start, CASE event_type WHEN 'click' THEN 'alignment' WHEN 'error' THEN 'naming' WHEN 'purchase' THEN 'missing' ELSE 'other' END AS code, count(*) AS n FROM events GROUP BY ALL"


@query(sql=RATE)
def findings_rate(t: Tables):
    return logs.findings_rate(t.issue).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_findings_rate", sql=f"SELECT * FROM ({RATE}) WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)")
def stream_findings_rate(t: Tables):
    """Windows closed by the watermark; the last two hours stay open."""
    code = F.expr("CASE event_type WHEN 'click' THEN 'alignment' WHEN 'error' THEN 'naming' WHEN 'purchase' THEN 'missing' ELSE 'other' END")
    events = jobs.table_stream(t.spark, t.folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), code.alias("code"))
    closed = jobs.run_to_table(jobs.findings_rate(events), jobs.run_folder(t.spark, "findings_rate"))
    return closed.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_votes", uses="vote", sql="""WITH l AS (SELECT key, voter, arg_max(verdict, (ts, event_id)) AS verdict FROM vote GROUP BY ALL),
c AS (SELECT key, count(*) FILTER (verdict = 'major') AS n_major, count(*) FILTER (verdict = 'minor') AS n_minor FROM l GROUP BY key)
SELECT *, CASE WHEN n_major >= 2 THEN 'confirmed' WHEN n_major = 1 OR n_minor >= 2 THEN 'disputed' ELSE 'clean' END AS status FROM c""")
def stream_votes(t: Tables):
    verdict = F.expr("CASE WHEN value > 60 THEN 'major' WHEN value > 30 THEN 'minor' ELSE 'ok' END")
    votes = jobs.table_stream(t.spark, t.folder, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("voter"), verdict.alias("verdict"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    out = jobs.run_to_table(jobs.vote_stream(votes), jobs.run_folder(t.spark, "votes"), "update")
    return reports.latest_by_key(out, ["key"], ["batch_no"]).select("key", "n_major", "n_minor", "status")


@query("stream_routes", sql=f"{SCORED} SELECT event_id, place, form_id, score FROM ranked WHERE place <= 3")
def stream_routes(t: Tables):
    static = case_events(t).select("case_id", "case_type", "roles", "facts", "filers").dropDuplicates(["case_id"])
    arriving = jobs.table_stream(t.spark, t.folder, "events").select(
        "event_id", F.col("user_id").alias("case_id"), F.col("event_type").alias("type"), F.from_json("props", "map<string,string>").alias("payload")
    )
    stream = jobs.route_stream(arriving.join(static, "case_id"), form_routes(*catalogue(t)), k=3)
    return jobs.run_to_table(stream, jobs.run_folder(t.spark, "routes"))
