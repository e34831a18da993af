"""Structured Streaming over execution events; equal to the batch operators at every trigger.

One query keeps the state of every line in the state store (see `lines`): a trigger reads and writes
the state of the lines it has events of, and nothing else. It puts out what changed: new events, each
exactly once however late a copy comes, quantities that turned out to be corrections, and lines that
became idle or active again. Every trigger writes folders of its own number, so a trigger that is
repeated replaces itself. Nothing waits for a watermark and nothing is dropped: the watermark
follows the clock of arrival and only drives the timers.

The copies of an event carry the line of the first one, and events of one line are in one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from replenish.functions.exprs import codes
from replenish.operators import execution
from replenish.streaming.lines import (
    ACTIVE,
    CHANGES,
    CORRECTED,
    EVENT,
    IDLE,
    KINDS,
    PACKED,
    PackedLineProcessor,
    packed,
    unpacked,
)

IDLE_DAYS = 1

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest(
    stream: DataFrame,
    folder: str,
    checkpoint: str | None = None,
    clock: Column | None = None,
    idle_days: int = IDLE_DAYS,
) -> StreamingQuery:
    """Brings everything under `folder` up to date with new events.

    `clock` is the time of arrival, by which lines become idle. It may stand still from one trigger to
    the next but must not fall: Spark would take such rows for late ones. Without it the time of
    the trigger counts. Days are those of UTC.
    """
    spark = stream.sparkSession
    at = F.current_timestamp() if clock is None else clock
    timed = execution.normalize(stream).select("line_id", packed().alias("event"), at.alias("clock"))
    changes = timed.withWatermark("clock", "1 millisecond").groupBy("line_id").transformWithState(
        PackedLineProcessor(idle_days), PACKED, "Update", "EventTime"
    )

    def write(batch: DataFrame, number: int) -> None:
        path = f"{folder}/changes/batch={number}"
        unpacked(batch).write.mode("overwrite").partitionBy("kind").parquet(path)
        written = batch.sparkSession.read.schema(CHANGES).parquet(path)
        fresh = written.filter(F.col("kind") == EVENT)
        execution.daily_counts(fresh).write.mode("overwrite").parquet(f"{folder}/daily/batch={number}")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return (
            changes.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint or f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Everything the triggers put out, with the number of the trigger."""
    schema = StructType([*CHANGES.fields, StructField("batch", LongType())])
    try:
        return spark.read.schema(schema).parquet(f"{folder}/changes")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every event once."""
    return read_changes(spark, folder).filter(F.col("kind") == EVENT).drop("kind", "batch")


def read_state(spark: SparkSession, folder: str, checkpoint: str | None = None) -> DataFrame:
    """The state of every line, from the state store; equal to `execution.fold` over all events."""
    stored = (
        spark.read.format("statestore")
        .option("path", checkpoint or f"{folder}/checkpoint")
        .option("stateVarName", "totals")
        .load()
        .select(F.col("key.line_id"), "value.*")
    )
    last_at = F.timestamp_micros("last_at").cast("timestamp")
    utc = F.to_utc_timestamp(last_at, F.current_timezone()).cast("timestamp_ntz")
    last = F.struct(
        utc.alias("occurred_at"), F.col("last_key").alias("dedup_key"), F.col("last_status").alias("normalized_status")
    )
    sums = [f"{k}_{mode}" for k in KINDS for mode in ("delta", "cumulative")]
    return execution.line_state(
        stored.select("line_id", *sums, last.alias("last"), "event_count", "unknown_events")
    )


def read_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Events per business day and type; a late event counts on its day."""
    return spark.read.parquet(f"{folder}/daily").groupBy("day", "event_type").agg(
        F.sum("events").alias("events"),
        F.sum("quantity").alias("quantity"),
        F.max("max_lag_seconds").alias("max_lag_seconds"),
    )


def read_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative quantities below the highest one before them in external time. An event that is
    one stays one, so this is a plain list."""
    found = read_changes(spark, folder).filter(F.col("kind") == CORRECTED)
    lower = codes((F.lit(True), "CUMULATIVE_DECREASED")).alias("correction_alert")
    return found.select("dedup_key", "line_id", "event_type", "quantity", "occurred_at", lower)


def read_idle(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are reported as idle and not active since: line_id, last_activity, batch."""
    reports = read_changes(spark, folder).filter(F.col("kind").isin(IDLE, ACTIVE))
    last = F.max(F.struct("batch", "occurred_at", "kind")).alias("last")
    return (
        reports.groupBy("line_id").agg(last)
        .filter(F.col("last.kind") == IDLE)
        .select("line_id", F.col("last.occurred_at").alias("last_activity"), F.col("last.batch").alias("batch"))
    )


def idle(
    spark: SparkSession, folder: str, as_of: date, days: int, checkpoint: str | None = None
) -> DataFrame:
    """Imported lines without activity for `days` days before any date, from the state so far."""
    return execution.idle(read_state(spark, folder, checkpoint), as_of, days)
