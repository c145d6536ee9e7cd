"""Streaming queries: the drained stream against SQL over all events, open windows included."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.plans.registry import Section
from tradeweave.streaming import monitors as M

section = Section()
QUERIES, ORACLES = section.queries, section.oracles
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) AS is_closed"


def ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def drained(m, monitor):
    return M.run_stream(M.event_stream(m.spark, m.folder), monitor)


@section.add("x1_daily_totals_stream", f"""
SELECT *, {CLOSED} FROM (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
 event_type, count(*) AS n, round(sum(value) + 1e-9, 2) AS total FROM events GROUP BY 1, 2, 3)""")
def x1(m):
    return ntz(drained(m, M.daily_totals()))


@section.add("x1_sliding_week_stream", f"""
SELECT *, {CLOSED} FROM (SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, event_type, count(*) AS n,
 round(avg(value) + 1e-9, 4) AS mean_value FROM (SELECT *, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start
 FROM events, (SELECT unnest(generate_series(0, 6)) AS k)) GROUP BY 1, 2, 3)""")
def x1b(m):
    return ntz(drained(m, M.sliding_week()))


@section.add("x2_milestone_sessions_stream", f"""
SELECT *, {CLOSED} FROM (SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, count(*) AS n,
 round(sum(value) + 1e-9, 2) AS total FROM (
 SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)) GROUP BY user_id, s)""")
def x2(m):
    return ntz(drained(m, M.milestone_sessions()))


@section.add("x3_deduplicated_milestones_stream", """
SELECT event_id, user_id, event_type FROM (
 SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR ts > prev + INTERVAL 2 HOUR""")
def x3(m):
    return drained(m, M.first_milestones())
