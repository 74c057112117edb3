"""Streams over event, vote, message and finding tables.

Each job takes a streaming DataFrame and gives one; ``run_to_table`` drives a
job over what has arrived so far and leaves its output in a table folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import citations, reports, routing
from formloom.operators.logs import CHAIN, MAX_ATTEMPTS
from formloom.session import ensure_checkpoint_dir
from formloom.streaming.processors import ChainLinks, Panel, RunFold

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(spark: SparkSession, folder: str, name: str, per_batch: int = 1) -> DataFrame:
    """A table as a stream, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # the pattern names the table alone; a plain path must be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/{name}.parque[t]")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/streams/{name}-{uuid.uuid4().hex}"


def run_to_table(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Process all available input and read the output back.

    Update-mode results are kept per micro-batch, with the batch number, so
    that the latest row per key can be taken on reading.
    """
    spark = stream.sparkSession
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"

    def keep(batch: DataFrame, number: int) -> None:
        # overwriting one folder per batch makes a replayed batch harmless
        batch.withColumn("batch_no", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).outputMode("append").start()
    else:
        query = writer.foreachBatch(keep).outputMode(mode).start()
    query.awaitTermination()
    if mode == "append":
        return spark.read.schema(stream.schema).parquet(out)
    return spark.read.parquet(out).drop("batch")


def with_state_store(spark: SparkSession) -> None:
    """Keyed state and timers need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def _timed(stream: DataFrame, late: str, *columns: str) -> DataFrame:
    """Event times to the millisecond, with a watermark."""
    return stream.select(*columns, F.date_trunc("millisecond", "ts").alias("ts")).withWatermark("ts", late)


def run_state(log: DataFrame, max_attempts: int = MAX_ATTEMPTS, late: str = "1 hour", keep_hours: float = 24 * 90) -> DataFrame:
    """Item states as actions arrive (update mode).

    Each update is the state after all actions that have arrived, in the order
    of (ts, event_id): an action up to ``late`` behind finds its place, a later
    one is dropped by the watermark.  Items without an action for ``keep_hours``
    are forgotten; an action after that starts anew.
    """
    with_state_store(log.sparkSession)
    fold = RunFold(max_attempts, int(keep_hours * 3_600_000))
    keyed = _timed(log, late, "item", "event_id", "action").groupBy("item")
    return keyed.transformWithStateInPandas(fold, "item bigint, status string, attempts bigint", "Update", "EventTime")


def append_chain(entries: DataFrame, late: str = "1 hour") -> DataFrame:
    """Hash-chain entries (log_key, ts, order_id, payload) as they arrive.

    An entry is linked once the watermark has passed it, in the order of (ts,
    order_id), so entries that come out of order give the chain of the batch
    twin.  Entries more than ``late`` behind are rejected: their place in the
    chain is taken.  The end of a chain is kept for good, or the log would break.
    """
    with_state_store(entries.sparkSession)
    keyed = _timed(entries, late, "log_key", "order_id", "payload").groupBy("log_key")
    return keyed.transformWithStateInPandas(ChainLinks(), CHAIN, "Append", "EventTime")


def route_stream(events: DataFrame, routes: DataFrame, k: int) -> DataFrame:
    """Best forms for each arriving event, without state.

    The catalogue is gathered to one row of routes a key; an event looks up its
    four keys and ranks what it finds inside its own row.
    """
    return routing.top_forms_in_row(events, routes, k)


def vote_stream(votes: DataFrame, late: str = "1 hour", keep_hours: float = 24 * 90) -> DataFrame:
    """Consensus on each key as votes come in (update mode).

    A vote that is delivered again counts once (by event id, within ``late``);
    the latest of each voter counts, whatever batch brought it.  Keys without a
    vote for ``keep_hours`` are forgotten.
    """
    with_state_store(votes.sparkSession)
    once = _timed(votes, late, "key", "voter", "event_id", "verdict").dropDuplicatesWithinWatermark(["event_id"])
    panel = Panel(int(keep_hours * 3_600_000))
    counted = once.groupBy("key").transformWithStateInPandas(panel, "key bigint, n_major bigint, n_minor bigint", "Update", "EventTime")
    return counted.withColumn("status", reports.consensus_status())


def guard_messages(messages: DataFrame, forms, authorities: DataFrame) -> DataFrame:
    """Citations of arriving assistant messages that are not in the index."""
    docs = messages.where("role = 'assistant'").select(F.col("conv_id").alias("doc_id"), "text")
    hits = citations.scan_mentions(docs, forms)
    return hits.join(authorities.select("cite", F.lit(True).alias("_k")), "cite", "left").where("_k IS NULL").select(
        F.col("doc_id").alias("conv_id"), "cite"
    )


def findings_rate(findings: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Findings per window and code; rows later than ``late`` are dropped."""
    return (
        findings.withWatermark("ts", late)
        .groupBy(F.window("ts", every).alias("w"), "code")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "code", "n")
    )
