"""Streams give the same complete result for any layout of the events, and agree with their batch form."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tradeweave.session import shared_dir
from tradeweave.streaming import monitors

MONITORS = [monitors.daily_totals, monitors.sliding_week, monitors.milestone_sessions, monitors.first_milestones]


@pytest.fixture(scope="module")
def layouts(spark, mart):
    """One file, six and two hundred files whose order has nothing to do with event time."""
    folders = []
    for n in (1, 6, 200):
        folder = f"{shared_dir(spark)}/events-{n}-{uuid.uuid4().hex}"
        mart.events.repartition(n, F.xxhash64("event_id", F.lit(random.Random(n).random()))).write.parquet(f"{folder}/events.parquet")
        folders.append(folder)
    return folders


@pytest.mark.parametrize("monitor", MONITORS)
def test_any_layout_gives_the_batch_result(spark, mart, layouts, monitor):
    want = monitors.run_batch(mart.events, monitor()).collect()
    n = sum(r["n"] for r in want) if "n" in want[0] else None
    assert monitor is monitors.first_milestones or n == mart.events.count() * (7 if monitor is monitors.sliding_week else 1)
    for folder in layouts:
        got = monitors.run_stream(monitors.event_stream(spark, folder, files_per_trigger=40), monitor()).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_open_windows_are_marked(mart):
    rows = monitors.run_batch(mart.events, monitors.daily_totals())
    assert rows.filter("is_closed").count() > 0 < rows.filter("not is_closed").count()


def test_a_missing_table_is_an_error(spark):
    with pytest.raises(Exception):
        monitors.event_stream(spark, "/nowhere")


def test_readmission_after_a_quiet_time(spark):
    times = ["2024-01-01 00:00", "2024-01-01 01:00", "2024-01-01 02:30", "2024-01-01 04:31", "2024-01-01 04:32"]
    events = spark.createDataFrame([(i, t, 1, "a", 1.0) for i, t in enumerate(times)],
                                   "event_id long, ts string, user_id long, event_type string, value double")
    got = monitors.run_batch(events.withColumn("ts", F.to_timestamp("ts")), monitors.first_milestones())
    assert sorted(r["event_id"] for r in got.collect()) == [0, 3]
