"""Registered queries: upsert, watermarks, ingest plan / apply, completeness, gaps, backfill.

"History" and "landed" bars are both aggregated from ``orders``: history = bars of
orders before 2000-01-01 (priority 5-LOW has none, so it is a new ticker), landed =
bars of orders from 1999-10-01 on and all of 5-LOW, so they overlap, keep-last is
exercised, and both together are the whole table.  Watermarks, plans, completeness and
gaps are taken of whole tables, with the nations as tickers without history.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from barwright.operators import history as h
from barwright.operators.bars import ohlcv_bars
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register
from barwright.plans.sqlparts import BARS_SUPPLIER
from barwright.plans.sqlparts import r6 as sql_r6

BASE = ["open", "high", "low", "close"]
HIST_END = "2000-01-01"
LANDED_START = "1999-10-01"


def _orders_bars(o):
    return ohlcv_bars(o, "o_orderpriority", "o_orderdate", "o_totalprice", None, "day", "o_orderkey")


def history_bars(spark, sf):
    o = ds.table(spark, sf, "orders")
    return _orders_bars(o.filter((F.col("o_orderdate") < F.lit(HIST_END).cast("timestamp_ntz"))
                                 & (F.col("o_orderpriority") != "5-LOW")))


def landed_bars(spark, sf):
    o = ds.table(spark, sf, "orders")
    return _orders_bars(o.filter((F.col("o_orderdate") >= F.lit(LANDED_START).cast("timestamp_ntz"))
                                 | (F.col("o_orderpriority") == "5-LOW")))


def universe(spark, sf):
    return ds.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("ticker")).distinct()


def _bars_sql(where: str) -> str:
    return f"""SELECT o_orderpriority AS ticker, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS BIGINT) AS volume
  FROM orders WHERE {where} GROUP BY 1, 2"""


HIST_SQL = _bars_sql(f"o_orderdate < TIMESTAMP '{HIST_END}' AND o_orderpriority <> '5-LOW'")
LANDED_SQL = _bars_sql(f"(o_orderdate >= TIMESTAMP '{LANDED_START}' OR o_orderpriority = '5-LOW')")
UNIVERSE_SQL = "SELECT DISTINCT o_orderpriority AS ticker FROM orders"


@register("upsert_keep_last", f"""WITH u AS (
  SELECT *, 0 AS src FROM ({HIST_SQL}) a UNION ALL SELECT *, 1 AS src FROM ({LANDED_SQL}) b)
SELECT ticker, date, {sql_r6(BASE)}, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY src DESC) AS rn FROM u) t WHERE rn = 1""")
def upsert_keep_last(spark, sf):
    return r6(h.upsert_keep_last([history_bars(spark, sf), landed_bars(spark, sf)]))


@register("watermark", f"SELECT ticker, max(date) AS latest_date FROM ({BARS_SUPPLIER}) h GROUP BY ticker")
def watermark(spark, sf):
    return h.watermark(ds.daily_lineitem(spark, sf, by_supplier=True))


#: two days after the last ship date, at noon; the newest bars of suppliers end on different days
_NOW = "(SELECT date_trunc('day', max(l_shipdate)) + INTERVAL 36 HOUR FROM lineitem)"
_AGE = f"CAST(floor(date_diff('second', latest_date, {_NOW}) / 86400.0) AS BIGINT)"
ALL_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier UNION SELECT n_name FROM nation"


def _now(spark, sf):
    last = ds.table(spark, sf, "lineitem").agg(F.date_trunc("day", F.max("l_shipdate"))).first()[0]
    return last + datetime.timedelta(hours=36)


def _all_tickers(spark, sf):
    return _supplier_universe(spark, sf).unionByName(ds.table(spark, sf, "nation").select(F.col("n_name").alias("ticker")))


@register("ingest_plan", f"""WITH w AS (SELECT ticker, max(date) AS latest_date FROM ({BARS_SUPPLIER}) h GROUP BY ticker)
SELECT u.ticker, w.latest_date, CAST({_AGE} AS DOUBLE) AS days_since_update,
  CASE WHEN latest_date IS NULL THEN 'full' WHEN {_AGE} <= 1 THEN 'up_to_date' ELSE 'incremental' END AS action,
  CAST(CASE WHEN latest_date IS NULL THEN 30 WHEN {_AGE} <= 1 THEN 0 ELSE {_AGE} + 5 END AS BIGINT) AS days_to_request
FROM ({ALL_SQL}) u LEFT JOIN w ON u.ticker = w.ticker""")
def ingest_plan(spark, sf):
    """Ingest plan per ticker (M1).  The age is NULL for a ticker without history; it is
    returned as a double so that both engines hand NULL over as NaN."""
    p = h.ingest_plan(_all_tickers(spark, sf), ds.daily_lineitem(spark, sf, by_supplier=True), _now(spark, sf), days_back=30)
    return p.withColumn("days_since_update", F.col("days_since_update").cast("double"))


@register("ingest_apply", f"""WITH w AS (SELECT ticker, max(date) AS latest_date FROM ({HIST_SQL}) h GROUP BY ticker),
f AS (SELECT l.* FROM ({LANDED_SQL}) l LEFT JOIN w ON l.ticker = w.ticker
      WHERE w.latest_date IS NULL OR l.date > w.latest_date),
a AS (SELECT ticker, count(*) AS n FROM f GROUP BY ticker),
b AS (SELECT ticker, count(*) AS n FROM ({HIST_SQL}) h GROUP BY ticker)
SELECT u.ticker, CAST(coalesce(b.n, 0) AS BIGINT) AS rows_before, CAST(coalesce(a.n, 0) AS BIGINT) AS rows_added,
  CASE WHEN coalesce(a.n, 0) > 0 THEN 'updated' WHEN coalesce(b.n, 0) > 0 THEN 'up_to_date' ELSE 'failed' END AS status
FROM ({UNIVERSE_SQL}) u LEFT JOIN a ON u.ticker = a.ticker LEFT JOIN b ON u.ticker = b.ticker""")
def ingest_apply(spark, sf):
    return h.ingest_apply(history_bars(spark, sf), landed_bars(spark, sf), universe(spark, sf)).outcome


@register("ingest_history", f"""WITH w AS (SELECT ticker, max(date) AS latest_date FROM ({HIST_SQL}) h GROUP BY ticker),
f AS (SELECT l.* FROM ({LANDED_SQL}) l LEFT JOIN w ON l.ticker = w.ticker
      WHERE w.latest_date IS NULL OR l.date > w.latest_date),
u AS (SELECT *, 0 AS src FROM ({HIST_SQL}) a UNION ALL SELECT *, 1 AS src FROM f)
SELECT ticker, date, {sql_r6(BASE)}, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY src DESC) AS rn FROM u) t WHERE rn = 1""")
def ingest_history(spark, sf):
    """The new history after an incremental ingest (M2): watermark filter + keep-last."""
    return r6(h.ingest_apply(history_bars(spark, sf), landed_bars(spark, sf), universe(spark, sf)).history)


@register("ingest_output", f"""WITH w AS (SELECT ticker, max(date) AS latest_date FROM ({HIST_SQL}) h GROUP BY ticker),
f AS (SELECT l.* FROM ({LANDED_SQL}) l LEFT JOIN w ON l.ticker = w.ticker
      WHERE (w.latest_date IS NULL OR l.date > w.latest_date) AND l.ticker <> '1-URGENT'),
u AS (SELECT * FROM ({HIST_SQL}) a UNION ALL SELECT * FROM f)
SELECT ticker, date, {sql_r6(BASE)}, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM u) t
WHERE rn <= 30 AND ticker IN ({UNIVERSE_SQL})""")
def ingest_output(spark, sf):
    """The output of an ingest (M2): the last 30 bars per ticker of the universe, of tickers with
    new bars and of one without (1-URGENT lands nothing); the limit is the feature."""
    landed = landed_bars(spark, sf).where("ticker <> '1-URGENT'")
    return r6(h.ingest_apply(history_bars(spark, sf), landed, universe(spark, sf)).output)


@register("stage_outcome", f"""WITH b AS ({BARS_SUPPLIER}),
c AS (SELECT ticker, count(*) AS n, count(*) FILTER (WHERE NOT (day(date) = 13 OR (day(date) = 14 AND volume > 20))) AS kept
      FROM b GROUP BY ticker),
o AS (SELECT u.ticker, coalesce(n, 0) AS n, coalesce(kept, 0) AS kept FROM (
  SELECT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier UNION ALL SELECT n_name FROM nation) u LEFT JOIN c USING (ticker))
SELECT CAST(count(*) AS BIGINT) AS tickers_processed, CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS tickers_successful,
  CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS tickers_failed,
  printf('%.2f%%', count(*) FILTER (WHERE n > 0) * 100.0 / count(*)) AS success_rate,
  CAST(coalesce(sum(kept) FILTER (WHERE n > 0), 0) AS BIGINT) AS total_rows, 'partial_success' AS status,
  array_to_string(list_sort(list(ticker) FILTER (WHERE n = 0)), ',') AS failed_tickers,
  CAST((SELECT sum(n) FROM c WHERE ticker IS NOT NULL) - sum(kept) + (SELECT count(*) FROM b WHERE day(date) = 15) AS BIGINT) AS rows_dropped,
  'Failed to process ' || CAST(count(*) FILTER (WHERE n = 0) AS VARCHAR) || ' tickers' AS error_message FROM o""")
def stage_outcome(spark, sf):
    """Outcome of the feature stage (A9) with the rows that P3 drops: bars without close, volume,
    ticker; the nations are tickers without bars."""
    bars = ds.daily_lineitem(spark, sf, by_supplier=True)
    day = F.dayofmonth("date")
    bars = bars.withColumn("close", F.when(day != 13, F.col("close"))).withColumn(
        "volume", F.when((day != 14) | (F.col("volume") <= 20), F.col("volume")))
    lost = bars.where(day == 15).withColumn("ticker", F.lit(None).cast("string"))
    tickers = _supplier_universe(spark, sf).unionByName(ds.table(spark, sf, "nation").select(F.col("n_name").alias("ticker")))
    _, _, summary = h.stage_outcome(bars.unionByName(lost), tickers)
    return summary.withColumn("failed_tickers", F.array_join("failed_tickers", ","))


@register("completeness", f"""WITH c AS (SELECT ticker, count(*) AS n FROM ({BARS_SUPPLIER}) h GROUP BY ticker)
SELECT u.ticker, CAST(coalesce(n, 0) AS BIGINT) AS rows, coalesce(n, 0) >= 460 AS complete,
  CAST(greatest(460 - coalesce(n, 0), 0) AS BIGINT) AS missing_days
FROM ({ALL_SQL}) u LEFT JOIN c ON u.ticker = c.ticker""")
def completeness(spark, sf):
    return h.completeness(ds.daily_lineitem(spark, sf, by_supplier=True), _all_tickers(spark, sf), 460)


@register("gap_check", f"""SELECT ticker, max(date) AS latest_date,
  CAST(date_diff('day', CAST(max(date) AS DATE), CAST({_NOW} AS DATE)) AS BIGINT) AS days_behind,
  date_diff('day', CAST(max(date) AS DATE), CAST({_NOW} AS DATE)) > 1 AS needs_run
FROM ({BARS_SUPPLIER}) h GROUP BY ticker""")
def gap_check(spark, sf):
    g = h.gap_check(ds.daily_lineitem(spark, sf, by_supplier=True), _now(spark, sf))
    return g.withColumn("days_behind", F.col("days_behind").cast("long"))


@register("series_gaps", f"""SELECT ticker, prev AS gap_start, date AS gap_end,
  CAST(date_diff('day', CAST(prev AS DATE), CAST(date AS DATE)) - 1 AS BIGINT) AS missing_days
FROM (SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS prev FROM ({BARS_SUPPLIER}) b) t
WHERE prev IS NOT NULL AND date_diff('day', CAST(prev AS DATE), CAST(date AS DATE)) >= 2""")
def series_gaps(spark, sf):
    """Gaps inside the supplier-level daily series (M4)."""
    return h.series_gaps(ds.daily_lineitem(spark, sf, by_supplier=True))


SUPP_UNIVERSE_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier"


def _supplier_universe(spark, sf):
    return ds.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"))


@register("backfill_outcome", f"""WITH c AS (SELECT ticker, count(*) AS n FROM ({BARS_SUPPLIER}) b GROUP BY ticker),
o AS (SELECT u.ticker, coalesce(n, 0) AS rows, coalesce(n, 0) > 0 AS ok FROM ({SUPP_UNIVERSE_SQL}) u
      LEFT JOIN c ON u.ticker = c.ticker)
SELECT CAST(count(*) AS BIGINT) AS tickers_processed, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS tickers_successful,
  CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS tickers_failed,
  printf('%.2f%%', CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE ok) * 100.0 / count(*) ELSE 0.0 END) AS success_rate,
  CAST(coalesce(sum(rows) FILTER (WHERE ok), 0) AS BIGINT) AS total_rows,
  CASE WHEN count(*) FILTER (WHERE NOT ok) = 0 THEN 'success' WHEN count(*) FILTER (WHERE ok) > 0
       THEN 'partial_success' ELSE 'failed' END AS status,
  array_to_string(coalesce(list_sort(list(ticker) FILTER (WHERE NOT ok)), []), ',') AS failed_tickers
FROM o""")
def backfill_outcome(spark, sf):
    """Backfill of supplier-level bars for every supplier (M13) and its summary."""
    _, outcome = h.backfill(ds.daily_lineitem(spark, sf, by_supplier=True), _supplier_universe(spark, sf))
    s = h.outcome_summary(outcome)
    return s.withColumn("failed_tickers", F.array_join("failed_tickers", ","))


@register("source_fallback", f"""WITH p AS ({BARS_SUPPLIER.replace("FROM lineitem", "FROM lineitem WHERE l_returnflag = 'R'")}),
s AS ({BARS_SUPPLIER.replace("FROM lineitem", "FROM lineitem WHERE l_returnflag <> 'R'")}),
pk AS (SELECT DISTINCT ticker FROM p)
SELECT ticker, date, {sql_r6(BASE)}, volume, 'primary' AS source FROM p
UNION ALL
SELECT ticker, date, {sql_r6(BASE)}, volume, 'secondary' AS source FROM s WHERE ticker NOT IN (SELECT ticker FROM pk)""")
def source_fallback(spark, sf):
    """Primary source (returned lines) for a supplier if it has any rows, else the
    secondary source (S14): a union with an anti-join on the primary's tickers."""
    li = ds.table(spark, sf, "lineitem")
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    tb = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    mk = lambda d: ohlcv_bars(d, F.col("l_suppkey").cast("string"), "l_shipdate", price, "l_quantity", "day", tb).withColumn(
        "volume", F.col("volume").cast("bigint"))
    rows, _ = h.source_fallback(mk(li.filter(F.col("l_returnflag") == "R")), mk(li.filter(F.col("l_returnflag") != "R")), _supplier_universe(spark, sf))
    return r6(rows)


@register("fallback_failures", """WITH t AS (SELECT CAST(l_orderkey AS VARCHAR) AS ticker, max(CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS best
  FROM lineitem GROUP BY 1)
SELECT 'primary' AS source, CAST(count(*) FILTER (WHERE best = 2) AS BIGINT) AS tickers FROM t
UNION ALL SELECT 'secondary', count(*) FILTER (WHERE best = 1) FROM t
UNION ALL SELECT 'failed', (SELECT count(DISTINCT o_orderkey) FROM orders) - (SELECT count(*) FROM t JOIN (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS k FROM orders) o ON k = ticker WHERE best > 0)""")
def fallback_failures(spark, sf):
    """Orders by the source that has their lines, returned lines first, accepted ones next, and the
    orders that neither has (S14)."""
    li = ds.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("ticker"), "l_returnflag", "l_shipdate")
    orders = ds.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("ticker"))
    rows, failed = h.source_fallback(li.where("l_returnflag = 'R'"), li.where("l_returnflag = 'A'"), orders)
    both = rows.select("ticker", "source").distinct().unionByName(failed.select("ticker", F.lit("failed").alias("source")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("tickers"))
