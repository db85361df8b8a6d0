"""Registered queries: table round trips, partition listing / retention / freshness,
payload parsers, and the streaming forms.  Writes go to fresh directories under the
session's checkpoint dir (the cluster's shared folder)."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.functions.time import instant_to_wall, wall_to_instant
from barwright.operators.history import backfill
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register
from barwright.plans.q_history import HIST_SQL, LANDED_SQL, history_bars, landed_bars
from barwright.plans.sqlparts import BARS_EVENTS, BARS_ORDERS
from barwright.plans.sqlparts import r6 as sql_r6
from barwright.session import scratch_dir
from barwright.sources import fs, io
from barwright.sources.parse import error_mentions, html_constituents, vendor_series
from barwright.sources.landed import read_landed, write_ticker_files
from barwright.sources.store import HistoryStore
from barwright.streaming.bars import drain_bars, running_indicators, upsert_stream

BASE = ["open", "high", "low", "close"]
AS_OF = "2001-08-01"


@register("year_partition_roundtrip", f"""SELECT ticker, CAST(year(date) AS INTEGER) AS year,
  CAST(count(*) AS BIGINT) AS rows, round(sum(close), 6) AS close_sum FROM ({BARS_ORDERS}) b GROUP BY 1, 2""")
def year_partition_roundtrip(spark, sf):
    """History written split by year (K2) and read back (S2): rows per ticker and year."""
    root = scratch_dir(spark, "history")
    io.write_history(ds.daily_orders(spark, sf), root)
    h = spark.read.parquet(root)
    return r6(h.groupBy("ticker", F.col("year").cast("int").alias("year"))
               .agg(F.count(F.lit(1)).cast("long").alias("rows"), F.sum("close").alias("close_sum")))


BAR_SCHEMA = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("date", T.TimestampNTZType()),
                           *[T.StructField(c, T.DoubleType()) for c in BASE],
                           T.StructField("volume", T.LongType())])


@register("format_roundtrip", " UNION ALL ".join(
    f"SELECT '{fmt}' AS fmt, ticker, date, {sql_r6(BASE)}, volume FROM ({BARS_ORDERS}) b"
    for fmt in ("csv", "json", "parquet")))
def format_roundtrip(spark, sf):
    """Bars written and read back as csv, json and parquet."""
    bars = ds.daily_orders(spark, sf)
    base = scratch_dir(spark, "formats")
    out = None
    for fmt in ("csv", "json", "parquet"):
        p = os.path.join(base, fmt)
        io.save(bars, p, fmt)
        back = io.load(spark, p, fmt, BAR_SCHEMA).withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return r6(out.select("fmt", "ticker", "date", *BASE, "volume"))


@register("vendor_json", f"SELECT ticker, date, {sql_r6(BASE)}, volume FROM ({BARS_ORDERS}) b")
def vendor_json(spark, sf):
    """Bars serialised as vendor daily-series payloads, one per ticker and month, then
    parsed back (S10)."""
    bars = ds.daily_orders(spark, sf)
    day = F.struct(*[F.col(c).cast("string").alias(f"{j + 1}. {c}") for j, c in enumerate(BASE)],
                   F.col("volume").cast("string").alias("5. volume"))
    payload = (bars.groupBy("ticker", F.date_trunc("month", "date").alias("m"))
               .agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct(
                   F.date_format("date", "yyyy-MM-dd"), day))).alias("Time Series (Daily)"))).alias("payload")))
    out, _ = vendor_series(payload, "payload", "ticker")
    return r6(out)


@register("vendor_errors", "SELECT event_type AS ticker, 'no series' AS error FROM events")
def vendor_errors(spark, sf):
    """The error path of the vendor parser (S10): every event's JSON ``props`` read as a vendor
    reply carries no series, so each becomes an error row with its reason."""
    e = ds.table(spark, sf, "events").select(F.col("event_type").alias("ticker"), F.col("props").alias("payload"))
    _, errors = vendor_series(e, "payload", "ticker")
    return errors


@register("html_constituents", r"""SELECT url, CAST(pos AS INTEGER) AS pos, symbol, company FROM (
  SELECT url, generate_subscripts(rows, 1) - 1 AS pos, unnest(rows) AS row FROM (
    SELECT url, regexp_extract_all(regexp_extract(html,
      '(?is)<table[^>]*class="[^"]*wikitable[^"]*"[^>]*>(.*?)</table>', 1), '(?is)<tr[^>]*>(.*?)</tr>', 1) AS rows
    FROM pages) a) b, LATERAL (SELECT
      trim(replace(regexp_replace(regexp_extract_all(row, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1)[1], '<[^>]*>', '', 'g'), '&amp;', '&')) AS symbol,
      trim(replace(regexp_replace(regexp_extract_all(row, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1)[2], '<[^>]*>', '', 'g'), '&amp;', '&')) AS company,
      len(regexp_extract_all(row, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1)) AS ncell) c
WHERE pos > 0 AND ncell >= 2 AND length(symbol) > 0 AND length(company) > 0""")
def html_constituents_q(spark, sf):
    """Constituent rows of the first wikitable of every page."""
    return html_constituents(ds.table(spark, sf, "pages"))


@register("log_counts", """SELECT source, CAST(count(*) AS BIGINT) AS docs,
  CAST(sum((length(lower(text)) - length(replace(lower(text), 'error', ''))) // 5) AS BIGINT) AS error_mentions,
  CAST(count(*) FILTER (WHERE (length(lower(text)) - length(replace(lower(text), 'error', ''))) > 0) AS BIGINT)
    AS docs_with_errors
FROM documents GROUP BY source""")
def log_counts(spark, sf):
    """Case-insensitive 'error' mentions per source over whole document texts."""
    d = ds.table(spark, sf, "documents").withColumn("_m", error_mentions(None, "text"))
    return d.groupBy("source").agg(F.count(F.lit(1)).cast("long").alias("docs"),
                                   F.sum("_m").cast("long").alias("error_mentions"),
                                   F.count_if(F.col("_m") > 0).cast("long").alias("docs_with_errors"))


MONTHS_SQL = f"SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS dt FROM ({BARS_ORDERS}) b"
MONTHS_TS_SQL = f"SELECT CAST(dt AS TIMESTAMP) AS dt FROM ({MONTHS_SQL}) x"


def _monthly_table(spark, sf):
    """Daily bars written as a dt-partitioned table, one partition per month."""
    root = scratch_dir(spark, "landed")
    bars = ds.daily_orders(spark, sf).withColumn("dt", F.to_date(F.date_trunc("month", "date")))
    io.write_partitioned(bars, root, ["dt"], cluster=["ticker", "date"])
    return root


@register("partition_files", f"SELECT dt, CAST(1 AS BIGINT) AS files FROM ({MONTHS_TS_SQL}) m")
def partition_files(spark, sf):
    """Partitions of a written table and their files, from the file listing."""
    files = io.partitions(spark, _monthly_table(spark, sf), "dt")
    return io.partition_profile(files, "dt").select(F.col("dt").cast("timestamp_ntz").alias("dt"), "files")


@register("retention_plan", f"""SELECT CAST(dt AS TIMESTAMP) AS dt, dt < DATE '{AS_OF}' - INTERVAL 30 DAY AS expired
FROM ({MONTHS_SQL}) m""")
def retention_plan(spark, sf):
    """Partitions older than 30 days before the as-of date (strict), as a plan (M6 dry run)."""
    files = io.partitions(spark, _monthly_table(spark, sf), "dt")
    cut = F.date_sub(F.lit(AS_OF).cast("date"), 30)
    return files.select("dt").distinct().select(F.col("dt").cast("timestamp_ntz").alias("dt"),
                                                (F.col("dt") < cut).alias("expired"))


@register("freshness", f"""SELECT CAST(max(dt) AS TIMESTAMP) AS latest_dt, CAST(count(*) AS BIGINT) AS partitions,
  CAST(date_diff('day', max(dt), DATE '{AS_OF}') AS INTEGER) AS days_old,
  array_to_string(list_sort(list(CAST(dt AS VARCHAR) ORDER BY dt DESC)[1:5]), ',') AS recent
FROM ({MONTHS_SQL}) m""")
def freshness(spark, sf):
    """Latest partition, partition count, age in days, last five partitions."""
    files = io.partitions(spark, _monthly_table(spark, sf), "dt")
    parts = files.select("dt").distinct()
    # the five newest by an ordered limit (top-k per task, then merged), tagged, then one
    # aggregate over (all partitions) U (five newest): no join, nothing unbounded collected
    top5 = parts.orderBy(F.col("dt").desc()).limit(5).select("dt", F.lit(True).alias("_top"))
    both = parts.select("dt", F.lit(False).alias("_top")).unionByName(top5)
    return both.agg(
        F.max("dt").cast("timestamp_ntz").alias("latest_dt"),
        F.count_if(~F.col("_top")).cast("long").alias("partitions"),
        F.datediff(F.lit(AS_OF).cast("date"), F.max("dt")).alias("days_old"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_top"), F.col("dt").cast("string")))), ",")
         .alias("recent"))


@register("stream_bars", f"SELECT ticker, date, {sql_r6(BASE)}, volume FROM ({BARS_EVENTS}) b")
def stream_bars(spark, sf):
    """Hourly bars from event files read as a stream (ST3), in two drops, each drained: the events
    up to the middle, every fifth of them sent twice (ST2); then the others with the last hour's
    again, and ticks for the first days under new ids, too late for their closed bars."""
    events = ds.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    half = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        F.timestamp_add("SECOND", F.floor(F.timestamp_diff("SECOND", F.col("a"), F.col("b")) / 2), F.col("a")).alias("cut"), "a").first()
    cut, start = F.lit(half["cut"]).cast("timestamp_ntz"), F.lit(half["a"]).cast("timestamp_ntz")
    old, new = events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)
    again = old.where(F.col("ts") >= cut - F.expr("INTERVAL 1 HOUR"))
    late = old.where(F.col("ts") < start + F.expr("INTERVAL 2 DAYS")).select(
        (-F.col("event_id") - 1).alias("event_id"), "event_type", "ts", (F.col("value") + 1e9).alias("value"))
    landing, out, ckpt = (scratch_dir(spark, n) for n in ("ticks", "bars", "bars-ckpt"))
    # event time as TIMESTAMP (watermarks need it), read as UTC so that windows align to
    # wall-clock hours whatever the session time zone
    zoned = lambda df: df.withColumn("ts", wall_to_instant(F.col("ts")))
    bars = None
    for drop in (old.unionByName(old.where("event_id % 5 = 0")), new.unionByName(again).unionByName(late)):
        drop.write.mode("append").parquet(landing)
        bars = drain_bars(zoned(spark.readStream.schema(events.schema).parquet(landing)), zoned(spark.read.schema(events.schema).parquet(landing)),
                          out, ckpt, "event_type", "ts", "value", "event_id", dedupe_key="event_id")
    return r6(bars.select("ticker", instant_to_wall(F.col("start")).alias("date"), *BASE, "volume"))


@register("stream_upsert", f"""WITH u AS (
  SELECT *, 0 AS src FROM ({HIST_SQL}) a UNION ALL SELECT *, 1 AS src FROM ({LANDED_SQL}) b)
SELECT ticker, date, {sql_r6(BASE)}, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY src DESC) AS rn FROM u) t WHERE rn = 1""")
def stream_upsert(spark, sf):
    """Landed CSV files merged into the history store by a stream, several files per micro-batch
    (ST1); the last batches come again under a new checkpoint and change nothing."""
    store = HistoryStore(spark, scratch_dir(spark, "stream-history"), buckets=4)
    store.upsert(history_bars(spark, sf))
    landing = scratch_dir(spark, "stream-landing")
    landed = landed_bars(spark, sf).withColumn("dt", F.to_date(F.date_trunc("month", "date")))
    io.write_partitioned(landed, landing, ["dt"], "csv", cluster=["ticker", "date"], header="true")
    upsert_stream(spark, landing, store, scratch_dir(spark, "stream-upsert-ckpt"), files_per_batch=64)
    upsert_stream(spark, landing, store, scratch_dir(spark, "stream-upsert-ckpt"), files_per_batch=64)
    return r6(store.read().select("ticker", "date", *BASE, F.col("volume").cast("bigint").alias("volume")))


@register("landed_keep_last", """SELECT o_orderpriority AS ticker, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date,
  round(arg_max(o_totalprice, o_orderkey), 6) AS close, round(arg_max(o_totalprice / 8, o_orderkey), 6) AS volume,
  CAST(arg_max(o_orderkey, o_orderkey) AS BIGINT) AS line FROM orders GROUP BY 1, 2""")
def landed_keep_last(spark, sf):
    """Every order landed as a line of ``dt=<date>/<TICKER>.csv`` (S1), so most keys are repeated
    inside a file; the last line of a key in file order wins (U2) in a backfill (M13)."""
    o = ds.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("ticker"), F.date_trunc("day", "o_orderdate").alias("date"),
        F.col("o_totalprice").alias("close"), (F.col("o_totalprice") / 8).alias("volume"), F.col("o_orderkey").alias("line"))
    root = scratch_dir(spark, "raw-files")
    write_ticker_files(o, root, "2001-08-01", ["line"])
    hist, _ = backfill(read_landed(spark, root), o.select("ticker").distinct())
    return r6(hist.select("ticker", "date", "close", "volume", F.col("line").cast("bigint").alias("line")))


@register("landed_latest", f"""SELECT ticker, date, {sql_r6(BASE)}, round(CASE WHEN volume % 3 = 0 THEN NULL ELSE volume / 4.0 END, 6) AS volume,
  CAST(max(date_trunc('month', date)) OVER () AS TIMESTAMP) AS dt
FROM ({BARS_ORDERS}) b QUALIFY date_trunc('month', date) = max(date_trunc('month', date)) OVER ()""")
def landed_latest(spark, sf):
    """The latest landed date (S3) of a table landed by month, volumes with fractions and NaN."""
    root = scratch_dir(spark, "raw-latest")
    volume = F.when(F.col("volume") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("volume") / 4.0)
    bars = ds.daily_orders(spark, sf).withColumn("volume", volume).withColumn("dt", F.to_date(F.date_trunc("month", "date")))
    io.write_partitioned(bars, root, ["dt", "ticker"], "csv", cluster=["date"], header="true")
    back = read_landed(spark, root, "latest")
    return r6(back.select("ticker", "date", *BASE, "volume", F.col("dt").cast("timestamp_ntz").alias("dt")))


@register("history_store", f"""WITH b AS ({BARS_ORDERS}), u AS (
  SELECT ticker, date, open, high, low, close, CAST(volume AS DOUBLE) AS volume, 0 AS src FROM b WHERE year(date) < 2000
  UNION ALL SELECT ticker, date, open, high, low, close + 1, volume / 2.0, 1 FROM b WHERE year(date) >= 1998 AND ticker <> '5-LOW')
SELECT ticker, CAST(year(date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS rows, round(sum(close), 6) AS close_sum,
  round(sum(volume), 6) AS volume_sum FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY src DESC) AS rn FROM u) t
WHERE rn = 1 AND year(date) IN (1997, 1998, 1999, 2000) GROUP BY 1, 2""")
def history_store(spark, sf):
    """Two batches merged into the versioned store (K2, U2) and four of its years read back (S2);
    the second batch is sent twice, old versions are deleted in between."""
    store = HistoryStore(spark, scratch_dir(spark, "store"), buckets=4)
    bars = ds.daily_orders(spark, sf).withColumn("volume", F.col("volume").cast("double"))
    store.upsert(bars.where("year(date) < 2000"), ("orders", 0))
    second = bars.where("year(date) >= 1998 AND ticker <> '5-LOW'").withColumn("close", F.col("close") + 1).withColumn("volume", F.col("volume") / 2)
    store.upsert(second, ("orders", 1))
    store.vacuum(1)
    store.upsert(second, ("orders", 1))
    h = store.read(years=[1997, 1998, 1999, 2000])
    return r6(h.groupBy("ticker", "year").agg(F.count(F.lit(1)).cast("long").alias("rows"), F.sum("close").alias("close_sum"),
                                              F.sum("volume").alias("volume_sum")))


@register("history_files", f"""SELECT CAST(year(date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS rows, true AS several_files,
  true AS disjoint FROM ({BARS_ORDERS}) b GROUP BY 1""")
def history_files(spark, sf):
    """Layout of the year-partitioned history (K2): several files a year, with disjoint ranges of
    (ticker, date), so that their bounds prune."""
    root = scratch_dir(spark, "layout")
    io.write_partitioned(ds.daily_orders(spark, sf).withColumn("year", F.year("date")), root, ["year"], cluster=["ticker", "date"], splits=40)
    key = F.struct("ticker", "date")
    files = io.read_history(spark, root).withColumn("file", F.col("_metadata.file_path")).groupBy("year", "file").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("a"), F.max(key).alias("b"))
    later = F.lead("a").over(Window.partitionBy("year").orderBy("a"))
    return files.withColumn("ok", F.coalesce(F.col("b") < later, F.lit(True))).groupBy(F.col("year").cast("int").alias("year")).agg(
        F.sum("n").cast("long").alias("rows"), (F.count(F.lit(1)) > 1).alias("several_files"), F.min("ok").alias("disjoint"))


@register("landed_roundtrip", f"SELECT ticker, date, {sql_r6(BASE)}, volume FROM ({BARS_ORDERS}) b")
def landed_roundtrip(spark, sf):
    """Bars landed as CSV under dt=/ticker= (K3, one dt per month) and read back."""
    root = scratch_dir(spark, "raw")
    bars = ds.daily_orders(spark, sf).withColumn("dt", F.to_date(F.date_trunc("month", "date")))
    io.write_partitioned(bars, root, ["dt", "ticker"], "csv", cluster=["date"], header="true")
    back = read_landed(spark, root)
    return r6(back.select("ticker", "date", *BASE, F.col("volume").cast("bigint").alias("volume")))


SPLIT_AT = "2024-01-16 00:00:00"


_RSI_W = "(PARTITION BY ticker ORDER BY i ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
_AG = f"avg(CASE WHEN close - pc > 0 THEN close - pc ELSE 0 END) OVER {_RSI_W}"
_AL = f"avg(CASE WHEN close - pc < 0 THEN pc - close ELSE 0 END) OVER {_RSI_W}"


@register("stream_running_ema", """WITH RECURSIVE b AS (""" + BARS_EVENTS + """),
s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i,
             lag(close) OVER (PARTITION BY ticker ORDER BY date) AS pc FROM b),
r AS (SELECT ticker, i, CASE WHEN i >= 13 THEN (CASE WHEN """ + _AL + """ = 0 AND """ + _AG + """ > 0 THEN 100.0
        WHEN """ + _AL + """ = 0 THEN NULL ELSE 100.0 - 100.0 / (1.0 + """ + _AG + """ / """ + _AL + """) END) END AS rsi
      FROM s),
e (ticker, i, e12, e26, sig) AS (
  SELECT ticker, i, close, close, CAST(0.0 AS DOUBLE) FROM s WHERE i = 0
  UNION ALL
  SELECT x.ticker, x.i, (2.0/13) * x.close + (1 - 2.0/13) * e.e12, (2.0/27) * x.close + (1 - 2.0/27) * e.e26,
         (2.0/10) * (((2.0/13) * x.close + (1 - 2.0/13) * e.e12) - ((2.0/27) * x.close + (1 - 2.0/27) * e.e26))
           + (1 - 2.0/10) * e.sig
  FROM e JOIN s x ON x.ticker = e.ticker AND x.i = e.i + 1)
SELECT s.ticker, s.date, round(e.e12, 6) AS ema_12, round(e.e26, 6) AS ema_26, round(e.e12 - e.e26, 6) AS macd,
  round(e.sig, 6) AS macd_signal, round(r.rsi, 6) AS rsi_14
FROM s JOIN e ON s.ticker = e.ticker AND s.i = e.i JOIN r ON s.ticker = r.ticker AND s.i = r.i""")
def stream_running_ema(spark, sf):
    """Running EMA / MACD / RSI continued over a stream (ST4): hourly bars land in two chunks (before and
    after 2024-01-16); two availableNow runs on one checkpoint, the second resuming from the
    carries of the first."""
    bars = ds.hourly_events(spark, sf)
    landing, out, ckpt = (scratch_dir(spark, n) for n in ("run-landing", "run-out", "run-ckpt"))
    cut = F.lit(SPLIT_AT).cast("timestamp_ntz")
    schema = bars.schema
    rows = None
    for part in (bars.filter(F.col("date") < cut), bars.filter(F.col("date") >= cut)):
        part.write.mode("append").parquet(landing)
        rows = running_indicators(spark.readStream.schema(schema).parquet(landing), out, ckpt)
    return r6(rows.select("ticker", "date", "ema_12", "ema_26", "macd", "macd_signal", "rsi_14"))
