"""Streaming monitors that give one complete result however the events are laid out in files.

Files arrive in any order of event time, so no micro-batch may decide what is too late. Every micro-batch appends
mergeable parts (window sums, bursts with their bounds) under its batch number; a repeated batch replaces its own part.
Reading the monitor merges the parts. Windows that the latest event does not close yet are there too, marked by
`is_closed`. The batch form of a monitor is the same merge over the parts of a single batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeweave.session import forget_at_exit, shared_dir
from tradeweave.sources.tables import SCHEMAS

DELAY = "2 hours"  # a window counts as closed once an event this much later than its end was seen


def event_time(events: DataFrame) -> DataFrame:
    """Zone-less event times as instants (UTC session)."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """The events table as a stream, be it one file or a folder of files. A missing or empty table is an error."""
    path = f"{folder.rstrip('/')}/events.parquet"
    if not spark.read.schema(SCHEMAS["events"]).parquet(path).inputFiles():
        raise FileNotFoundError(f"no event files in {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", files_per_trigger)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory():
        return event_time(stream.parquet(path))
    return event_time(stream.option("pathGlobFilter", "events.parquet").parquet(folder))


@dataclass(frozen=True)
class Monitor:
    """`part` turns events into mergeable rows (with `last_ts`, the latest event), `merge` makes the result of them."""

    name: str
    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def _closed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    latest = parts.agg(F.max("last_ts")).scalar()
    return rows.withColumn("is_closed", F.col("window_end") <= latest - F.expr(f"INTERVAL {DELAY}"))


def window_monitor(name: str, length: str, slide: str | None, measure: Callable[[], object], digits: int,
                   output: str) -> Monitor:
    """Counts and a measure of the value per event type and window."""
    def part(events: DataFrame) -> DataFrame:
        window = F.window("ts", length, slide) if slide else F.window("ts", length)
        return events.groupBy(window.alias("w"), "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count("value").alias("values"),
            F.max("ts").alias("last_ts")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "total", "values",
            "last_ts")

    def merge(parts: DataFrame) -> DataFrame:
        rows = parts.groupBy("window_start", "window_end", "event_type").agg(
            F.sum("n").alias("n"), F.round(measure() + F.lit(1e-9), digits).alias(output))
        return _closed(rows, parts)
    return Monitor(name, part, merge)


def daily_totals() -> Monitor:
    return window_monitor("daily", "1 day", None, lambda: F.sum("total"), 2, "total")


def sliding_week() -> Monitor:
    """Seven-day mean per day of slide."""
    return window_monitor("week", "7 days", "1 day", lambda: F.try_divide(F.sum("total"), F.sum("values")), 4, "mean_value")


def bursts(events: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Runs of events of a key whose neighbours are at most `gap` apart; bounds come out as aggregates."""
    return events.groupBy(F.session_window("ts", gap).alias("w"), *keys).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total"), F.min(F.struct("ts", "event_id"))["event_id"].alias("event_id")).drop("w")


def merged_bursts(parts: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Bursts of parts that overlap or lie at most `gap` apart are one."""
    by = Window.partitionBy(*keys).orderBy("first_ts", "event_id")
    reach = F.max("last_ts").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first_ts") > reach + F.expr(f"INTERVAL {gap}"), F.lit(True)).cast("int")
    numbered = parts.withColumn("begins", begins).withColumn("burst", F.sum("begins").over(by))
    return numbered.groupBy(*keys, "burst").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n"),
        F.sum("total").alias("total"), F.min(F.struct("first_ts", "event_id"))["event_id"].alias("event_id")).drop("burst")


def milestone_sessions(gap: str = "6 hours") -> Monitor:
    """Bursts of milestones per shipment owner, ended by a quiet gap."""
    def merge(parts: DataFrame) -> DataFrame:
        rows = merged_bursts(parts, ["user_id"], gap).select(
            "user_id", F.col("first_ts").alias("window_start"),
            (F.col("last_ts") + F.expr(f"INTERVAL {gap}")).alias("window_end"), "n", F.round(F.col("total") + F.lit(1e-9), 2).alias("total"))
        return _closed(rows, parts)
    return Monitor("sessions", lambda events: bursts(events, ["user_id"], gap), merge)


def first_milestones(quiet: str = DELAY) -> Monitor:
    """The first event of each (user, type), and again of each that follows a quiet time of that key."""
    keys = ["user_id", "event_type"]
    return Monitor("first", lambda events: bursts(events, keys, quiet),
                   lambda parts: merged_bursts(parts, keys, quiet).select("event_id", *keys))


def run_batch(events: DataFrame, monitor: Monitor) -> DataFrame:
    return monitor.merge(monitor.part(event_time(events)))


def run_stream(stream: DataFrame, monitor: Monitor) -> DataFrame:
    """Drain the available input into parts and merge them. State and parts go when the application ends."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/stream-{monitor.name}-{uuid.uuid4().hex}"
    forget_at_exit(spark, base)

    def keep(batch: DataFrame, number: int) -> None:
        monitor.part(batch).write.mode("overwrite").parquet(f"{base}/parts/batch={number}")

    query = (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return monitor.merge(spark.read.parquet(f"{base}/parts").drop("batch"))
