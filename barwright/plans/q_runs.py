"""Registered queries: run-log statistics and rules over a run log derived from ``events``
(one run per user; see ``runs.runs_from_events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.functions.nulls import safe_divide as _safe_divide
from barwright.operators import runs as r
from barwright.operators.reports import integrity_rules
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register

AS_OF = "2024-01-31 12:00:00"

RUNS_SQL = """SELECT user_id AS run_id, min(ts) AS start_time,
  CASE WHEN arg_max(event_type, row(ts, event_id)) = 'signup' THEN NULL ELSE max(ts) END AS end_time,
  CASE WHEN arg_min(event_type, row(ts, event_id)) IN ('view', 'purchase') THEN 'daily'
       WHEN arg_min(event_type, row(ts, event_id)) = 'click' THEN 'weekly'
       WHEN arg_min(event_type, row(ts, event_id)) = 'signup' THEN 'test' ELSE 'manual' END AS mode,
  CASE WHEN arg_max(event_type, row(ts, event_id)) = 'signup' THEN 'running'
       WHEN arg_max(event_type, row(ts, event_id)) = 'error' THEN 'failed' ELSE 'completed' END AS status,
  CAST(count(*) FILTER (WHERE event_type = 'error' AND value > 400) AS INTEGER) AS retry_count,
  CASE WHEN arg_max(event_type, row(ts, event_id)) = 'error'
       THEN 'stage ' || arg_min(event_type, row(ts, event_id)) || ' failed. code ' || CAST(count(*) AS VARCHAR) || '; see log'
  END AS error_message
FROM events GROUP BY user_id"""

DUR = "date_diff('microsecond', start_time, end_time) / 1e6"


def runs(spark, sf):
    return r.runs_from_events(ds.table(spark, sf, "events"))


@register("run_log", f"SELECT * FROM ({RUNS_SQL}) r")
def run_log(spark, sf):
    return runs(spark, sf)


@register("run_stats", f"""SELECT CAST(count(*) AS BIGINT) AS total_runs,
  CAST(count(*) FILTER (WHERE status = 'completed') AS BIGINT) AS successful_runs,
  CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed_runs,
  CAST(count(*) FILTER (WHERE retry_count > 0) AS BIGINT) AS retried_runs,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*) ELSE 0.0 END, 6)
    AS success_rate,
  round(coalesce(avg(CASE WHEN end_time IS NOT NULL THEN {DUR} END), 0.0), 6) AS average_runtime_seconds
FROM ({RUNS_SQL}) r""")
def run_stats(spark, sf):
    return r6(r.run_stats(runs(spark, sf)))


@register("runs_by_mode", f"""SELECT coalesce(mode, 'unknown') AS mode, CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE status = 'completed') AS BIGINT) AS successful,
  CAST(count(*) - count(*) FILTER (WHERE status = 'completed') AS BIGINT) AS failed
FROM ({RUNS_SQL}) r GROUP BY 1""")
def runs_by_mode(spark, sf):
    return r.runs_by_mode(runs(spark, sf))


@register("error_distribution", f"""SELECT split_part(split_part(error_message, ';', 1), '.', 1) AS error_key,
  CAST(count(*) AS BIGINT) AS n FROM ({RUNS_SQL}) r
WHERE error_message IS NOT NULL AND error_message <> '' GROUP BY 1""")
def error_distribution(spark, sf):
    return r.error_distribution(runs(spark, sf))


@register("retry_candidates", f"""SELECT * FROM ({RUNS_SQL}) r
WHERE status = 'failed' AND coalesce(retry_count, 0) < 3 AND mode IN ('daily', 'weekly')""")
def retry_candidates(spark, sf):
    return r.retry_candidates(runs(spark, sf))


@register("stuck_runs", f"""SELECT run_id, start_time, mode,
  round(date_diff('microsecond', start_time, TIMESTAMP '{AS_OF}') / 1e6, 6) AS elapsed_seconds,
  'terminated' AS new_status
FROM ({RUNS_SQL}) r
WHERE status = 'running' AND date_diff('microsecond', start_time, TIMESTAMP '{AS_OF}') / 1e6 > 7200""")
def stuck_runs(spark, sf):
    return r6(r.stuck_runs(runs(spark, sf), AS_OF))


@register("stage_rollup", """SELECT user_id AS run_id, event_type AS stage, ts AS timestamp,
  CAST(row_number() OVER w AS BIGINT) AS tickers_processed, CAST(count(*) OVER p AS BIGINT) AS total_tickers,
  round(row_number() OVER w * 100.0 / count(*) OVER p, 6) AS progress_percent,
  round(date_diff('microsecond', min(ts) OVER p, ts) / 1e6, 6) AS elapsed_seconds
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), p AS (PARTITION BY user_id)""")
def stage_rollup(spark, sf):
    return r6(r.checkpoints_from_events(ds.table(spark, sf, "events")))


@register("dashboard_summary", f"""SELECT CAST(count(*) AS BIGINT) AS total_runs,
  CAST(count(*) FILTER (WHERE status = 'completed') AS BIGINT) AS successful_runs,
  CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed_runs,
  CAST(count(*) FILTER (WHERE status = 'running') AS BIGINT) AS running_runs,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*) ELSE 0.0 END, 6)
    AS success_rate,
  round(coalesce(avg(CASE WHEN end_time IS NOT NULL THEN {DUR} END), 0.0), 6) AS average_runtime_seconds
FROM (SELECT * FROM ({RUNS_SQL}) r ORDER BY start_time DESC, run_id DESC LIMIT 10) t""")
def dashboard_summary(spark, sf):
    """Summary of the last 10 runs (A13) - the limit is the feature."""
    return r6(r.dashboard_summary(runs(spark, sf), 10))


def _fmt_sql(x: str) -> str:
    s = f"round(({x}) * 10.0) / 10.0"
    return (f"CASE WHEN ({x}) < 60 THEN printf('%.1fs', {s}) "
            f"WHEN ({x}) < 3600 THEN printf('%.1fm', round(({x}) / 60.0 * 10.0) / 10.0) "
            f"ELSE printf('%.1fh', round(({x}) / 3600.0 * 10.0) / 10.0) END")


@register("format_time", f"""SELECT run_id, {_fmt_sql(DUR)} AS runtime FROM ({RUNS_SQL}) r WHERE end_time IS NOT NULL""")
def format_time(spark, sf):
    """Run durations formatted as x.xs / x.xm / x.xh (F8)."""
    d = runs(spark, sf).filter(F.col("end_time").isNotNull())
    return d.select("run_id", r.format_time(r.seconds_between(F.col("end_time"), F.col("start_time"))).alias("runtime"))


@register("safe_divide", """SELECT l_orderkey, l_linenumber, l_partkey,
  round(CASE WHEN l_tax = 0 THEN 0.0 ELSE l_discount / l_tax END, 6) AS discount_per_tax FROM lineitem""")
def safe_divide(spark, sf):
    """safe_divide(discount, tax, default 0) over every line item (F1)."""
    li = ds.table(spark, sf, "lineitem")
    return r6(li.select("l_orderkey", "l_linenumber", "l_partkey",
                        _safe_divide(F.col("l_discount"), F.col("l_tax"), 0.0).alias("discount_per_tax")))


RULES_FACTS_SQL = """SELECT user_id AS run_id, count(*) > 0 AS processed_exists,
    count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*) AS missing_pct,
    date_diff('microsecond', min(ts), max(ts)) / 1e6 / 60.0 AS runtime_minutes,
    CAST(count(*) FILTER (WHERE event_type = 'error' AND value > 400) AS INTEGER) AS failed_tests,
    count(*) FILTER (WHERE event_type = 'view') * 100.0 / count(*) AS null_pct
  FROM events GROUP BY user_id"""

_SEV = """greatest(CASE WHEN NOT processed_exists THEN 2 ELSE 0 END, CASE WHEN missing_pct > 50 THEN 1 ELSE 0 END,
                  CASE WHEN runtime_minutes > 5 THEN 1 ELSE 0 END, CASE WHEN failed_tests > 0 THEN 2 ELSE 0 END,
                  CASE WHEN null_pct > 10 THEN 1 ELSE 0 END)"""


@register("status_rules", f"""SELECT run_id,
  CASE {_SEV} WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS status,
  NULLIF(concat_ws('; ',
    CASE WHEN NOT processed_exists THEN 'No processed data found - pipeline may have failed' END,
    CASE WHEN missing_pct > 50 THEN 'High missing data percentage: '
         || printf('%.1f', round(missing_pct * 10.0) / 10.0) || '%' END,
    CASE WHEN runtime_minutes > 5 THEN 'Pipeline runtime exceeded threshold' END,
    CASE WHEN failed_tests > 0 THEN CAST(failed_tests AS VARCHAR) || ' tests failed - investigate immediately' END,
    CASE WHEN null_pct > 10 THEN 'High null percentage in processed data' END), '') AS recommendations
FROM ({RULES_FACTS_SQL}) x""")
def status_rules(spark, sf):
    """Integrity-report rules (Q4) per run of the derived run log: error share stands for
    missing data, 'view' share for nulls, high-value errors for failed tests."""
    e = ds.table(spark, sf, "events")
    n = F.count(F.lit(1))
    facts = e.groupBy(F.col("user_id").alias("run_id")).agg(
        (n > 0).alias("processed_exists"),
        (F.count_if(F.col("event_type") == "error") * 100.0 / n).alias("missing_pct"),
        (r.seconds_between(F.max("ts"), F.min("ts")) / 60.0).alias("runtime_minutes"),
        F.count_if((F.col("event_type") == "error") & (F.col("value") > 400)).cast("int").alias("failed_tests"),
        (F.count_if(F.col("event_type") == "view") * 100.0 / n).alias("null_pct"))
    out = integrity_rules(facts)
    joined = F.concat_ws("; ", F.col("recommendations"))
    return out.select("run_id", "status", F.when(joined != "", joined).alias("recommendations"))
