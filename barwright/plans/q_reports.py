"""Registered queries: report rules, run state and flags, retention, time-zone edges,
test-mode limit, table copy and store metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import reports as rp
from barwright.operators import runs as r
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register
from barwright.plans.q_runs import DUR, RUNS_SQL, runs
from barwright.plans.sqlparts import BARS_ORDERS, BARS_SUPPLIER
from barwright.plans.sqlparts import r6 as sql_r6
from barwright.session import scratch_dir
from barwright.sources import io

BASE = ["open", "high", "low", "close"]


@register("run_rules", f"""WITH s AS (SELECT count(*) FILTER (WHERE status = 'failed') AS failed_runs,
  count(*) FILTER (WHERE retry_count > 0) AS retried_runs,
  avg(CASE WHEN end_time IS NOT NULL THEN {DUR} END) AS average_runtime_seconds FROM ({RUNS_SQL}) r)
SELECT CASE WHEN failed_runs > 0 OR retried_runs > 0 OR coalesce(average_runtime_seconds, 0) > 3600
            THEN 'warning' ELSE 'healthy' END AS status,
  CAST((failed_runs > 0)::INT + (retried_runs > 0)::INT + (coalesce(average_runtime_seconds, 0) > 3600)::INT AS INTEGER)
    AS rules_fired FROM s""")
def run_rules(spark, sf):
    """Run-log rules (Q5) over the run log derived from events."""
    out = rp.run_rules(runs(spark, sf))
    return out.select("status", F.size("rules_fired").alias("rules_fired"))


@register("dashboard_recommendations", f"""WITH l AS (SELECT * FROM ({RUNS_SQL}) r ORDER BY start_time DESC, run_id DESC LIMIT 10),
e AS (SELECT split_part(split_part(error_message, ';', 1), '.', 1) AS k, count(*) AS n
      FROM l WHERE error_message IS NOT NULL AND error_message <> '' GROUP BY 1)
SELECT DISTINCT recommendation FROM (
  SELECT CASE WHEN count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*) < 80
         THEN 'Low success rate detected - investigate recent failures' END AS recommendation FROM l
  UNION ALL SELECT CASE WHEN coalesce(sum(n) FILTER (WHERE k = 'stage click failed'), 0) > 2
         THEN 'Multiple fetch_data failures - check API connectivity' END FROM e
  UNION ALL SELECT CASE WHEN coalesce(sum(n) FILTER (WHERE k = 'stage view failed'), 0) > 1
         THEN 'Feature processing issues detected - review data quality' END FROM e) x
WHERE recommendation IS NOT NULL""")
def dashboard_recommendations(spark, sf):
    """Dashboard rules (Q6): 'stage click failed' stands for fetch failures and
    'stage view failed' for feature failures."""
    return rp.dashboard_recommendations(runs(spark, sf), "stage click failed", "stage view failed")


@register("pipeline_report", f"""SELECT run_id,
  CASE WHEN retry_count > 0 THEN 'critical' WHEN {DUR} > 300 THEN 'warning' ELSE 'healthy' END AS status,
  NULLIF(concat_ws('; ', CASE WHEN retry_count > 0 THEN 'Investigate failed tests' END,
                   CASE WHEN {DUR} > 300 THEN 'Pipeline runtime exceeded threshold' END), '') AS recommendation
FROM ({RUNS_SQL}) r WHERE end_time IS NOT NULL""")
def pipeline_report(spark, sf):
    """Pipeline report rules (Q7) per ended run: retries stand for failed tests."""
    d = runs(spark, sf).filter(F.col("end_time").isNotNull())
    st, rec = rp.pipeline_report(F.col("retry_count"), r.seconds_between(F.col("end_time"), F.col("start_time")))
    return d.select("run_id", st.alias("status"), rec.alias("recommendation"))


@register("run_state", """SELECT user_id AS run_id, arg_max(event_type, row(ts, event_id)) AS state,
  max(ts) AS updated, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY user_id""")
def run_state(spark, sf):
    """Current state of each run from appended state events (M9)."""
    e = ds.table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("state"),
                                             F.col("ts").alias("updated"), "event_id")
    return rp.run_state(e, "run_id", "updated", "event_id").drop("event_id")


@register("run_flags", f"""SELECT run_id, mode, CASE WHEN mode = 'test' THEN 'test' ELSE 'production' END AS environment,
  CASE WHEN mode IN ('daily', 'weekly') THEN 'cron' ELSE 'manual' END AS triggered_by, mode = 'test' AS is_test
FROM ({RUNS_SQL}) r""")
def run_flags(spark, sf):
    return rp.run_flags(runs(spark, sf)).select("run_id", "mode", "environment", "triggered_by", "is_test")


@register("runlog_retention", f"""SELECT run_id, start_time FROM ({RUNS_SQL}) r
WHERE start_time >= TIMESTAMP '2024-01-02 06:00:00' - INTERVAL 1 DAY""")
def runlog_retention(spark, sf):
    """Runs kept by a 1-day run-log retention as of 2024-01-02 06:00."""
    return rp.runlog_retention(runs(spark, sf), "2024-01-02 06:00:00", 1).select("run_id", "start_time")


@register("timezone_edges", """SELECT event_id, ts AS wall_clock, ts - INTERVAL 5 HOUR - INTERVAL 30 MINUTE AS utc
FROM events""")
def timezone_edges(spark, sf):
    """Event times stamped '+05:30': strip the zone (P9) and convert to UTC (P10)."""
    e = ds.table(spark, sf, "events")
    txt = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    return e.select("event_id", rp.strip_zone(txt).alias("wall_clock"), rp.to_utc(txt).alias("utc"))


@register("test_mode_tickers", f"""SELECT b.ticker, b.date, {sql_r6(BASE)}, b.volume FROM ({BARS_SUPPLIER}) b
WHERE ticker IN (SELECT DISTINCT ticker FROM ({BARS_SUPPLIER}) c ORDER BY ticker LIMIT 5)""")
def test_mode_tickers(spark, sf):
    """Test mode (P11): the first five supplier tickers only - the limit is the feature."""
    return r6(rp.first_tickers(ds.daily_lineitem(spark, sf, by_supplier=True), 5))


@register("dropped_tickers", f"""SELECT DISTINCT ticker FROM ({BARS_SUPPLIER}) b
WHERE ticker NOT IN (SELECT ticker FROM ({BARS_SUPPLIER}) c GROUP BY ticker HAVING count(*) >= 500)""")
def dropped_tickers(spark, sf):
    """Tickers the 500-row depth filter drops."""
    bars = ds.daily_lineitem(spark, sf, by_supplier=True)
    deep = bars.groupBy("ticker").count().filter(F.col("count") >= 500).select("ticker")
    return rp.dropped_tickers(bars, bars.join(deep, "ticker", "left_semi"))


@register("copy_table", """SELECT CAST(count(*) AS BIGINT) AS rows_source, CAST(count(*) AS BIGINT) AS rows_copy,
  true AS ok FROM lineitem""")
def copy_table(spark, sf):
    """Copy lineitem to another store and compare counts."""
    return rp.copy_table(spark, f"{sf}/lineitem.parquet", scratch_dir(spark, "copy"))


@register("store_metadata", f"""SELECT CAST(count(DISTINCT ticker) AS BIGINT) AS ticker_count,
  CAST(count(*) AS BIGINT) AS total_rows, min(date) AS start_date, max(date) AS end_date,
  array_to_string(list_sort(list(DISTINCT ticker)), ',') AS tickers, 'ticker,date,open,high,low,close,volume' AS columns
FROM ({BARS_ORDERS}) b""")
def store_metadata(spark, sf):
    """Bars stored as Parquet and CSV, with the metadata row (K6)."""
    meta = rp.store_data(ds.daily_orders(spark, sf), scratch_dir(spark, "store"))
    return meta.withColumn("tickers", F.array_join("tickers", ","))


@register("table_quality", f"""WITH b AS ({BARS_ORDERS})
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT ticker) AS BIGINT) AS tickers,
  round(CASE WHEN count(*) > 0 THEN ((count(*) - count(ticker)) + (count(*) - count(date)) + (count(*) - count(open))
        + (count(*) - count(high)) + (count(*) - count(low)) + (count(*) - count(close)) + (count(*) - count(volume)))
        * 100.0 / (count(*) * 7) END, 6) AS null_pct,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b) d) AS BIGINT) AS duplicate_rows FROM b""")
def table_quality(spark, sf):
    """Availability and quality of the daily bar table (Q3)."""
    return r6(rp.table_quality(ds.daily_orders(spark, sf)))


@register("report_retention", f"""SELECT path,
  CASE WHEN kind <> 'log' THEN CAST(dt AS TIMESTAMP) END AS file_date,
  kind <> 'log' AND dt < DATE '2001-08-01' - INTERVAL 90 DAY AS expired
FROM (SELECT DISTINCT date AS dt, ['daily', 'weekly', 'summary', 'log'][1 + CAST(day(date) % 4 AS INTEGER)] AS kind,
        'reports/2020-01-01/' || kind || '/' || strftime(date, '%Y-%m-%d') || '.json' AS path FROM ({BARS_ORDERS}) b) m""")
def report_retention(spark, sf):
    """Report files older than 90 days (M7): one listed file per bar date, in four folders of
    which one holds no reports."""
    kind = F.element_at(F.array(*map(F.lit, ("daily", "weekly", "summary", "log"))), F.dayofmonth("date") % 4 + 1)
    files = ds.daily_orders(spark, sf).select(F.concat(F.lit("reports/2020-01-01/"), kind, F.lit("/"),
                                                       F.date_format("date", "yyyy-MM-dd"), F.lit(".json")).alias("path")).distinct()
    out = rp.report_retention(files, "2001-08-01", 90)
    return out.select("path", F.col("file_date").cast("timestamp_ntz").alias("file_date"), "expired")
