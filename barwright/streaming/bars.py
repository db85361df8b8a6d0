"""Structured Streaming forms of the batch operators (ST1-ST4).

* ``upsert_stream``: a landing directory as a stream; every micro-batch is merged into the
  versioned history store with keep-last in file order (ST1, the streaming form of M2).
* ``drain_bars``: ticks -> event-time OHLCV bars with a late-data bound (ST3), exact repeats
  dropped (ST2); closed bars are appended to files, open ones written beside them.
* ``running_indicators``: exponential means, MACD and RSI of every new bar, continued from one
  carry row per ticker (ST4).

All run with ``trigger(availableNow=True)``: process what has landed, then stop; the checkpoint
location makes a rerun resume where it left off, and a batch that comes again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators import indicators as ind
from barwright.operators.series import Layout, ema_family, prev_observation
from barwright.plans.features import layout_bars
from barwright.sources import fs
from barwright.sources.landed import file_lines, parse_lines
from barwright.sources.store import HistoryStore

# ---------------------------------------------------------------------------
# ST1: landed files into the history
# ---------------------------------------------------------------------------


def upsert_stream(spark: SparkSession, landing: str, store: HistoryStore, checkpoint: str,
                  files_per_batch: int = 1000, source: str = "landing") -> None:
    """Merge landed CSV files into the history store, one micro-batch at a time (ST1).

    A batch reads the live directories of the years and ticker buckets that it changes, nothing
    else, and the store keeps the number of the last batch of ``source``: a batch that is
    processed again, after a failure before or behind the manifest, leaves the same table."""
    lines = (spark.readStream.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
             .option("maxFilesPerTrigger", files_per_batch).load(landing)
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")))

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.upsert(parse_lines(file_lines(batch)).drop("dt"), (source, batch_id), "_seq")

    lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


# ---------------------------------------------------------------------------
# ST2, ST3: event-time bars
# ---------------------------------------------------------------------------

def tick_bars(ticks: DataFrame, ticker: str, ts: str, price: str, tiebreak: str, width: str = "1 hour",
              dedupe_key: str | None = None) -> DataFrame:
    """OHLCV bars per ticker and event-time window of ``width``; rows of one ``dedupe_key`` inside
    a window count once.  The same plan over a stream (with a watermark) or a table."""
    # one event-time column may be left: the window's; ticks are ordered by plain microseconds
    s = ticks.withColumn("_t", F.unix_micros(ts)).withColumn("w", F.window(ts, width)).drop(ts)
    if dedupe_key is not None:
        s = s.dropDuplicates([dedupe_key, "w"])
    order = F.struct("_t", tiebreak)
    return (s.groupBy(F.col(ticker).alias("ticker"), "w")
             .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                  F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                  F.count(F.lit(1)).cast("bigint").alias("volume"))
             .select("ticker", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "open", "high", "low", "close", "volume"))


def drain_bars(stream: DataFrame, table: DataFrame, out: str, checkpoint: str, ticker: str, ts: str, price: str,
               tiebreak: str, width: str = "1 hour", late: str = "1 hour", dedupe_key: str | None = None) -> DataFrame:
    """Bars of all ticks that have landed.

    The stream appends a bar to ``out/closed`` when the watermark (greatest event time less
    ``late``) passes its end; its state holds open windows only.  A tick is late, and dropped, when
    its window has closed.  The closing flush then computes the windows that are still open from
    ``table`` (the same ticks as a table, of which only those behind the watermark are read) and
    writes them to ``out/open``, replaced on every call.  Returns both as one table."""
    spark = stream.sparkSession
    bars = tick_bars(stream.withWatermark(ts, late), ticker, ts, price, tiebreak, width, dedupe_key)
    q = (bars.writeStream.format("parquet").option("path", f"{out}/closed").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    mark = F.lit("1970-01-01T00:00:00.000Z")
    if q.lastProgress is not None:
        mark = F.lit(q.lastProgress["eventTime"].get("watermark", "1970-01-01T00:00:00.000Z"))
    mark = mark.cast("timestamp")
    behind = table.where(F.col(ts) >= mark - F.expr(f"INTERVAL {width}"))
    still = tick_bars(behind, ticker, ts, price, tiebreak, width, dedupe_key).where(F.col("end") > mark)
    still.write.mode("overwrite").parquet(f"{out}/open")
    return spark.read.schema(bars.schema).parquet(f"{out}/closed").unionByName(spark.read.schema(bars.schema).parquet(f"{out}/open"))


# ---------------------------------------------------------------------------
# ST4: running indicators
# ---------------------------------------------------------------------------

#: last bars of a ticker that its carry holds: RSI looks back 14 deltas
TAIL = 15
#: after so many bars without a close an older mean has no weight left in double precision
GAP = 600
CARRY = ("ticker string, rows long, last_date timestamp_ntz, tail array<struct<date: timestamp_ntz, close: double>>, "
         "fast double, slow double, signal double, gap long")


def _seeded(new: DataFrame, carry: DataFrame) -> DataFrame:
    """New bars behind the last bars of their ticker's carry.  The first row of a carry's tail
    stands for everything before it: there the signal (``_g``) is seeded, and the means (``_f``,
    ``_s``) too, or on a row of their own, ``gap`` rows earlier, if that bar has no close."""
    new = new.select("ticker", "date", "close", F.lit(1).alias("_new"), *[F.lit(None).cast("double").alias(c) for c in ("_f", "_s", "_g")])
    bar = lambda date, close, mean, signal: F.struct(
        date.alias("date"), close.alias("close"), F.when(mean, F.col("fast")).alias("_f"), F.when(mean, F.col("slow")).alias("_s"),
        F.when(signal, F.col("signal")).alias("_g"))
    held = carry.where(F.size("tail") > 0)
    first = F.col("tail")[0]["date"]
    blank = F.lit(None).cast("double")
    g = F.least(F.col("gap"), F.lit(GAP)).cast("int")
    before = F.when((g > 0) & F.col("fast").isNotNull(), F.transform(
        F.sequence(F.lit(0), g - 1), lambda j: bar(F.timestamp_add("MICROSECOND", j - g, first), blank, j == 0, F.lit(False))))
    tail = F.transform("tail", lambda t, j: bar(t["date"], t["close"], (j == 0) & (g == 0), j == 0))
    rows = held.select("ticker", F.inline(F.concat(F.coalesce(before, F.slice(tail, 1, 0)), tail)))
    return new.unionByName(rows.withColumn("_new", F.lit(0)))


def continue_indicators(new: DataFrame, carry: DataFrame, lay: Layout = Layout()) -> tuple[DataFrame, DataFrame]:
    """(indicators of the new bars, new carry).

    Bars not newer than their ticker's last one are late and dropped (the strict watermark rule of
    the batch ingest).  The new bars, behind at most ``TAIL + GAP`` carried rows per ticker, go
    through the block scan of the batch operators, so the bars of a hot ticker are split over
    tasks.  NULL closes follow pandas ``ignore_na=False``.  The carry has one row per ticker."""
    newer = (new.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
             .join(carry.select("ticker", "last_date"), "ticker", "left")
             .where(F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))).drop("last_date"))
    active = carry.join(newer.select("ticker").distinct(), "ticker", "left_semi")
    src = _seeded(newer, active).withColumn("_x", F.coalesce("_f", "close"))
    df, max_rows = layout_bars(src, lay, value="_x")
    df = ind.apply_levels(df, [{"_pobs": prev_observation("_x", lay)}], ind.rsi(lay, "close", 14, "rsi_14"))
    df = ema_family(df, lay, "_x", F.col("_pobs"), {"ema_12": 12, "ema_26": 26}, max_rows,
                    signal=("macd_signal", 9, "ema_12", "ema_26"), seeds={"ema_12": "_f", "ema_26": "_s", "macd_signal": "_g"})
    own = df.where("_h = 0")
    out = own.where("_new = 1").select("ticker", "date", "ema_12", "ema_26", (F.col("ema_12") - F.col("ema_26")).alias("macd"),
                                       "macd_signal", "rsi_14")
    last = own.where(F.col("_i") >= F.col("_n") - TAIL)
    seen = F.when(F.col("_x").isNotNull(), F.col("_i")).otherwise(F.col("_pobs"))
    at = F.struct(F.col("_i").alias("i"), "date", "close", F.col("ema_12").alias("fast"), F.col("ema_26").alias("slow"),
                  F.col("macd_signal").alias("signal"), (F.col("_i") - seen).alias("gap"))
    held = last.groupBy("ticker").agg(F.array_sort(F.collect_list(at)).alias("t"))  # TAIL rows of a ticker at most
    fresh = own.where("_new = 1").groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    done = held.join(fresh, "ticker").join(carry.select("ticker", F.col("rows").alias("_rows")), "ticker", "left").select(
        "ticker", (F.coalesce("_rows", F.lit(0)) + F.col("n")).alias("rows"), F.col("t")[F.size("t") - 1]["date"].alias("last_date"),
        F.transform("t", lambda x: F.struct(x["date"].alias("date"), x["close"].alias("close"))).alias("tail"),
        *[F.col("t")[0][c].alias(c) for c in ("fast", "slow", "signal")], F.coalesce(F.col("t")[0]["gap"], F.lit(0)).alias("gap"))
    rest = carry.join(done.select("ticker"), "ticker", "left_anti")
    return out, done.unionByName(rest.select(*done.columns))


def _latest(spark: SparkSession, root: str, before: int) -> str | None:
    """Newest complete carry of a batch before ``before``."""
    done = [int(n[len("batch="):]) for n in fs.subdirectories(spark, root, "batch=") if fs.exists(spark, f"{root}/{n}/_SUCCESS")]
    done = [b for b in done if b < before]
    return f"{root}/batch={max(done)}" if done else None


def running_indicators(bars: DataFrame, out: str, checkpoint: str, lay: Layout = Layout()) -> DataFrame:
    """Running ema_12 / ema_26 / macd / macd_signal / rsi_14 per ticker over a stream of bars (ST4).

    Each micro-batch writes its rows to ``out/rows/batch=<id>`` and the carries to
    ``out/carry/batch=<id>``, from those of the batch before: a batch that is processed again
    replaces its own two directories with the same rows.  Returns all rows."""
    spark = bars.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        path = _latest(spark, f"{out}/carry", batch_id)
        carry = spark.read.schema(CARRY).parquet(path) if path else spark.createDataFrame([], CARRY)
        rows, new = continue_indicators(batch.select("ticker", "date", "close"), carry, lay)
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        new.write.mode("overwrite").parquet(f"{out}/carry/batch={batch_id}")

    bars.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    names = "ticker string, date timestamp_ntz, ema_12 double, ema_26 double, macd double, macd_signal double, rsi_14 double"
    done = [f"{out}/rows/{n}" for n in fs.subdirectories(spark, f"{out}/rows", "batch=") if fs.exists(spark, f"{out}/rows/{n}/_SUCCESS")]
    return spark.read.schema(names).parquet(*done) if done else spark.createDataFrame([], names)
