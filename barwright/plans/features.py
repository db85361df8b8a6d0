"""Feature stage: the two indicator profiles over all tickers in one distributed pass.

standard (P3 after indicators, then last 30 rows per ticker):
  sma_50 sma_200 ema_26 macd macd_signal macd_histogram rsi_14 bb_middle bb_upper bb_lower
modular (P4 before indicators, >= 50-row gate, any-null rows dropped after):
  sma_20 sma_50 ema_12 ema_26 macd macd_signal rsi price_change price_change_pct
  volume_sma volume_ratio

Plan shape: scan -> index (exchange on ticker, bucket) -> halo blocks (exchange on
ticker, block) -> rolling windows and the local exponential scan in that partitioning ->
small carry tables joined back on (ticker, block).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.functions.nulls import nan_to_null_all
from barwright.operators import indicators as ind
from barwright.operators.bars import BASE_COLUMNS
from barwright.session import keep as keep_df
from barwright.session import materialize
from barwright.operators.series import (
    Layout, block_layout, block_table, ema_family, ends_sub_block, index_series, prev_observation,
    with_sub_blocks)

STANDARD_COLUMNS = ["sma_50", "sma_200", "ema_26", "macd", "macd_signal", "macd_histogram",
                    "rsi_14", "bb_middle", "bb_upper", "bb_lower"]
MODULAR_COLUMNS = ["sma_20", "sma_50", "ema_12", "ema_26", "macd", "macd_signal", "rsi",
                   "price_change", "price_change_pct", "volume_sma", "volume_ratio"]


def layout_bars(bars: DataFrame, lay: Layout = Layout(), bucket_days: int = 64,
                value: str = "close", keep=None):
    """Index (lineage cut by a checkpoint) + halo blocks + the per-block side table,
    repartitioned on (ticker, block).  Returns (layout, longest series)."""
    # the index reads its input twice (bucket counts and rows); the count side prunes
    # columns, so the two scans would not share an exchange: keep the input once
    bars = keep_df(nan_to_null_all(bars))
    idx = materialize(index_series(bars, lay.key, lay.order, bucket_days))
    max_rows = int(idx.agg(F.max("_n")).collect()[0][0] or 0)
    df = block_layout(idx, lay)
    side = block_table(df, lay, value, keep)
    # explicit partition count: AQE must not fold CPU-heavy window work into one task
    parts = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = with_sub_blocks(df.join(side, [lay.key, "_blk"], "left").repartition(parts, lay.key, "_blk"), lay)
    return df, max_rows


def macd_family(df: DataFrame, lay: Layout, max_rows: int, fast: int = 12, slow: int = 26,
                signal: int = 9, src: str = "close", fast_out: str = "_ema_f",
                slow_out: str = "_ema_s", macd_out: str = "macd", signal_out: str = "macd_signal",
                narrow=None) -> DataFrame:
    """ema fast / slow of ``src``, macd = fast - slow, signal = ema(signal) of macd (``narrow``: see
    ``ema_family``)."""
    df = ema_family(df, lay, src, F.col("_pobs"), {fast_out: fast, slow_out: slow}, max_rows,
                    signal=(signal_out, signal, fast_out, slow_out), narrow=narrow)
    df = df.withColumn(macd_out, F.col(fast_out) - F.col(slow_out))
    return df.drop(*[c for c in (fast_out, slow_out) if c.startswith("_")])


def _base_ok():
    ok = F.lit(True)
    for c in BASE_COLUMNS:
        ok = ok & F.col(c).isNotNull()
    return ok


def standard_features(bars: DataFrame, tail: int | None = 30, lay: Layout = Layout(),
                      min_rows: int | None = None, depth_on: str = "history") -> DataFrame:
    """The standard profile.  ``tail`` None keeps every row.

    ``min_rows``: drop tickers with fewer rows (the depth filter).  ``depth_on="history"``
    counts rows kept after P3 before the tail; ``"output"`` counts after the tail (the
    literal behaviour, which empties the output whenever min_rows > tail).
    """
    extras = [c for c in bars.columns if c not in BASE_COLUMNS + ["ticker"]]
    lay = replace(lay, by_sub=True)
    laid, max_rows = layout_bars(bars, lay, keep=_base_ok())
    keep = (F.col("_h") == 0) & _base_ok()
    pobs = [{"_pobs": prev_observation("close", lay)}]
    # indicators by the rows before a row that they look at, most first
    rolling = [(200, [ind.sma(lay, "close", 200, "sma_200")]),
               (50, [ind.sma(lay, "close", 50, "sma_50")]),
               (20, [ind.rsi(lay, "close", 14, "rsi_14"), ind.bollinger(lay, "close", 20, 2.0, "bb")])]
    if tail is None:
        df = ind.apply_levels(laid, pobs, *[i for _, group in rolling for i in group], [{"_out": keep}])
        df = macd_family(df, lay, max_rows, slow_out="ema_26")
    else:
        # the exponential means run over every row; the rolling frames only where the last rows
        # reach, and only those rows and the ends of sub-blocks are kept
        def narrow(d):
            for reach, group in rolling:
                d = d.filter((F.col("_left") < tail + reach) | ends_sub_block(lay))
                d = ind.apply_levels(d, *group)
            return d.filter(F.col("_out") | ends_sub_block(lay))

        df = ind.apply_levels(laid, pobs, ind.tail_flag(lay, tail, keep))
        df = macd_family(df, lay, max_rows, slow_out="ema_26", narrow=narrow)
    df = df.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    out = df.filter(F.col("_out"))
    if min_rows is not None:
        if depth_on == "history":
            counts = ind.kept_rows_per_ticker(laid.withColumn("_k", keep), lay, "_k", "_depth")
        else:
            counts = out.groupBy(lay.key).agg(F.count(F.lit(1)).alias("_depth"))
        out = out.join(counts.filter(F.col("_depth") >= min_rows).select(lay.key), lay.key, "left_semi")
    return out.select("ticker", *BASE_COLUMNS, *extras, *STANDARD_COLUMNS)


def modular_features(bars: DataFrame, lay: Layout = Layout(), min_rows: int = 50) -> DataFrame:
    """The modular profile: P4, then indicators for tickers with >= ``min_rows`` rows, then
    drop rows with any NULL (tickers below the gate keep all their rows, with NULL indicators)."""
    base = ["open", "high", "low", "close", "volume"]
    clean = bars.dropna(subset=base)
    df, max_rows = layout_bars(clean, lay)
    df = ind.apply_levels(
        df,
        [{"_pobs": prev_observation("close", lay)}],
        ind.sma(lay, "close", 20, "sma_20"),
        ind.sma(lay, "close", 50, "sma_50"),
        ind.rsi(lay, "close", 14, "rsi"),
        ind.pct_change(lay, "close", 1, "price_change"),
        ind.volume_ratio(lay, 20))
    df = df.withColumn("price_change_pct", F.col("price_change") * F.lit(100.0))
    df = macd_family(df, lay, max_rows, fast_out="ema_12", slow_out="ema_26")
    gated = F.col("_n") >= min_rows
    all_present = F.lit(True)
    other = [c for c in bars.columns if c not in base + ["ticker", "date"]]
    for c in MODULAR_COLUMNS + other:
        all_present = all_present & F.col(c).isNotNull()
    keep = (F.col("_h") == 0) & (~gated | all_present)
    cols = [F.when(gated, F.col(c)).alias(c) for c in MODULAR_COLUMNS]
    return df.filter(keep).select("ticker", "date", *base, *other, *cols)


def with_indicators(bars: DataFrame, *levels, emas: dict[str, float] | None = None,
                    macd: dict | None = None, lay: Layout = Layout(), src: str = "close") -> DataFrame:
    """All own rows of ``bars`` with the given indicator levels (see ``indicators``),
    optional exponential means ``emas`` (name -> span) and an optional MACD family
    (``macd`` = keyword arguments of ``macd_family``)."""
    df, max_rows = layout_bars(bars, lay, value=src)
    df = ind.apply_levels(df, [{"_pobs": prev_observation(src, lay)}], *levels)
    if emas:
        df = ema_family(df, lay, src, F.col("_pobs"), dict(emas), max_rows)
    if macd is not None:
        df = macd_family(df, lay, max_rows, src=src, **macd)
    internal = ["_n", "_i", "_h", "_blk", "_sb", "_pobs", "_pobs_blk", "_kafter"]
    return df.filter(F.col("_h") == 0).drop(*internal)
