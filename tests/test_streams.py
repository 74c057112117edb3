"""Streams over split input, and over a restart, equal their batch twins."""

import pytest
from pyspark.sql import functions as F

from formloom.operators import logs, reports
from formloom.operators.routing import form_routes
from formloom.plans import registry
from formloom.plans.logs import _as_log
from formloom.plans.routing import case_events, catalogue
from formloom.streaming import jobs


def split(spark, tables, folder, n, mixed=False):
    """Events cut into ``n`` files, arriving one per batch: in time order, or
    each with a share of all times."""
    events = tables.raw("events")
    step = events.count() // n + 1
    for i in range(n):
        part = F.col("event_id") % n == i if mixed else (F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step)
        events.where(part).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def as_set(df):
    return {tuple(r) for r in df.collect()}


def progress(stream, folder, mode="update"):
    """Run over all input and tell what the last batch reported."""
    query = stream.writeStream.option("checkpointLocation", str(folder)).trigger(availableNow=True).outputMode(mode)
    query = query.foreachBatch(lambda batch, number: batch.write.format("noop").mode("overwrite").save()).start()
    query.awaitTermination()
    return query.lastProgress


def state_rows(report):
    return sum(op["numRowsTotal"] for op in report["stateOperators"])


def entries_of(events):
    return events.select(F.col("user_id").alias("log_key"), F.col("event_id").alias("order_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("payload"))


def chain_of(events):
    ranked = events.selectExpr("user_id AS log_key", "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq", "event_type AS payload")
    return as_set(logs.append_chain(ranked.withColumn("seq", F.col("seq").cast("bigint"))))


@pytest.mark.parametrize(("n", "mixed"), [(1, False), (3, False), (4, True)])
def test_run_state(spark, tables, tmp_path, n, mixed):
    stream = jobs.run_state(_as_log(split(spark, tables, tmp_path / "in", n, mixed)), late="90 days")
    out = jobs.run_to_table(stream, str(tmp_path / "run"), "update")
    got = reports.latest_by_key(out, ["item"], ["batch_no"]).select("item", "status", "attempts")
    assert as_set(got) == as_set(logs.run_state(_as_log(tables.raw("events"))))


def test_run_state_folds_what_is_past_and_goes_on_after_a_restart(spark, tables, tmp_path):
    events, source = tables.raw("events"), str(tmp_path / "in")
    half = events.count() // 2
    for part in (F.col("event_id") < half, F.col("event_id") >= half):
        events.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.run_state(_as_log(spark.readStream.schema(events.schema).parquet(source)), late="1 hour")
        out = jobs.run_to_table(stream, str(tmp_path / "run"), "update")
    got = reports.latest_by_key(out, ["item"], ["batch_no"]).select("item", "status", "attempts")
    assert as_set(got) == as_set(logs.run_state(_as_log(events)))


def test_silent_items_are_forgotten(spark, tables, tmp_path):
    log = _as_log(split(spark, tables, tmp_path / "in", 4))
    kept = state_rows(progress(jobs.run_state(log, late="1 hour"), tmp_path / "kept"))
    left = state_rows(progress(jobs.run_state(log, late="1 hour", keep_hours=2), tmp_path / "left"))
    assert 0 < left < kept / 2


def test_chain_survives_a_restart(spark, tables, tmp_path):
    events = tables.raw("events")
    half = events.count() // 2
    source = str(tmp_path / "in")

    def entries():
        return entries_of(spark.readStream.schema(events.schema).parquet(source))

    events.where(F.col("event_id") < half).coalesce(1).write.mode("append").parquet(source)
    jobs.run_to_table(jobs.append_chain(entries(), "0 seconds"), str(tmp_path / "run"))
    events.where(F.col("event_id") >= half).coalesce(1).write.mode("append").parquet(source)
    both = jobs.run_to_table(jobs.append_chain(entries(), "0 seconds"), str(tmp_path / "run"))
    assert as_set(both) == chain_of(events)


def test_entries_out_of_order_are_linked_in_order_and_late_ones_rejected(spark, tables, tmp_path):
    events, source = tables.raw("events"), str(tmp_path / "in")
    last = events.agg(F.max("ts")).first()[0]
    for i in (2, 0, 1):
        events.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        jobs.run_to_table(jobs.append_chain(entries_of(stream), "60 days"), str(tmp_path / "run"))
    # A far later entry of another log moves the watermark past all of them ...
    mark = events.limit(1).withColumns({"user_id": F.lit(-1).cast("bigint"), "ts": F.lit(last) + F.expr("INTERVAL 100 DAYS")})
    mark.select(events.columns).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    jobs.run_to_table(jobs.append_chain(entries_of(stream), "60 days"), str(tmp_path / "run"))
    # ... so one that comes now has lost its place.
    events.limit(1).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    got = jobs.run_to_table(jobs.append_chain(entries_of(stream), "60 days"), str(tmp_path / "run"))
    assert as_set(got) == chain_of(events)


def votes_of(events):
    verdict = F.expr("CASE WHEN value > 60 THEN 'major' WHEN value > 30 THEN 'minor' ELSE 'ok' END")
    return events.select(F.col("user_id").alias("key"), F.col("event_type").alias("voter"), verdict.alias("verdict"), F.col("ts").cast("timestamp").alias("ts"), "event_id")


def test_votes(spark, tables, tmp_path):
    split(spark, tables, tmp_path / "in", 3, mixed=True)
    stream = votes_of(split(spark, tables, tmp_path / "in", 2))  # every vote is delivered twice
    out = jobs.run_to_table(jobs.vote_stream(stream, "90 days"), str(tmp_path / "run"), "update")
    got = reports.latest_by_key(out, ["key"], ["batch_no"]).select("key", "n_major", "n_minor", "status")
    assert as_set(got) == as_set(reports.vote_consensus(tables.vote).select(got.columns))


def test_votes_and_silent_keys_are_forgotten(spark, tables, tmp_path):
    votes = votes_of(split(spark, tables, tmp_path / "in", 4))
    kept = state_rows(progress(jobs.vote_stream(votes, "60 days"), tmp_path / "kept"))
    left = state_rows(progress(jobs.vote_stream(votes, "1 hour", keep_hours=2), tmp_path / "left"))
    assert 0 < left < kept / 2


def test_routes_need_no_state(spark, tables, tmp_path):
    static = case_events(tables).select("case_id", "case_type", "roles", "facts", "filers").dropDuplicates(["case_id"])
    arriving = split(spark, tables, tmp_path / "in", 3).select("event_id", F.col("user_id").alias("case_id"), F.col("event_type").alias("type"), F.from_json("props", "map<string,string>").alias("payload"))
    report = progress(jobs.route_stream(arriving.join(static, "case_id"), form_routes(*catalogue(tables)), 3), tmp_path / "run", "append")
    assert report["stateOperators"] == []


def test_findings_rate_leaves_only_open_windows_out(spark, tables, tmp_path):
    stream = split(spark, tables, tmp_path / "in", 3).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("code"))
    got = as_set(jobs.run_to_table(jobs.findings_rate(stream), str(tmp_path / "run")))
    batch = logs.findings_rate(tables.raw("events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("code")))
    want = as_set(batch)
    assert got < want
    last = max(w for w, _, _ in want)
    assert all((last - w).total_seconds() <= 3 * 3600 for w, _, _ in want - got)


def test_log_folds(spark):
    rows = [(1, 1, "begin"), (1, 2, "error"), (1, 3, "retry"), (2, 1, "begin"), (2, 2, "error"), (2, 3, "begin"), (2, 4, "error"), (2, 5, "begin"), (2, 6, "error"), (2, 7, "retry"), (3, 1, "begin"), (3, 2, "error"), (3, 3, "reset"), (3, 4, "begin"), (4, 1, "retry")]
    log = spark.createDataFrame([(i, e, e, a) for i, e, a in rows], "item bigint, ts bigint, event_id bigint, action string")
    got = {r.item: (r.status, r.attempts) for r in logs.run_state(log).collect()}
    assert got == {1: ("PENDING", 1), 2: ("DEAD", 3), 3: ("IN_PROGRESS", 1), 4: ("PENDING", 0)}


def test_a_table_may_be_a_folder_of_files(spark, tables, tmp_path):
    tables.raw("conversations").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    tables.raw("events").limit(1).write.parquet(str(tmp_path / "events.parquet"))
    query = registry.QUERIES["stream_guard"]
    assert as_set(query(spark, str(tmp_path))) == as_set(query(spark, tables.folder)) != set()
