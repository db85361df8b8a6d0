"""Bar tables: OHLCV bars from ticks (A22) and column normalisation at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.functions.nulls import nan_to_null

BASE_COLUMNS = ["date", "open", "high", "low", "close", "volume"]
PRICE_COLUMNS = ["open", "high", "low", "close"]

# Vendor column spellings mapped to ours.
VENDOR_ALIASES = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. volume": "volume",
    "stock splits": "stock_splits",
}


def ohlcv_bars(ticks: DataFrame, ticker: Column | str, ts: Column | str, price: Column | str,
               volume: Column | str | None = None, unit: str = "day",
               tiebreak: Column | str | list | None = None) -> DataFrame:
    """Aggregate ticks to bars: open = first price, close = last price, high, low, volume.

    ``unit`` is a ``date_trunc`` unit.  Ties on the timestamp are broken by ``tiebreak`` (a
    column or a list of columns, compared in order; kept flat in one struct, which is
    cheaper to compare than a nested one).
    ``volume`` None counts ticks; otherwise it is summed in its own type (fractions stay, decimals
    as double, NaN counts as missing).  Partial aggregation runs map-side, so a hot ticker
    is combined before the shuffle.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    t, p = col(ts), col(price)
    ties = [] if tiebreak is None else [col(c) for c in (tiebreak if isinstance(tiebreak, list) else [tiebreak])]
    order = F.struct(t, *ties) if ties else t
    if volume is None:
        vol = F.count(F.lit(1)).cast("bigint")
    else:
        kind = ticks.select(col(volume)).schema[0].dataType
        v = col(volume).cast("double") if isinstance(kind, T.DecimalType) else col(volume)
        vol = F.sum(nan_to_null(v) if isinstance(kind, (T.FloatType, T.DoubleType)) else v)
    return (ticks.groupBy(col(ticker).alias("ticker"), F.date_trunc(unit, t).cast("timestamp_ntz").alias("date"))
                 .agg(F.min_by(p, order).alias("open"),
                      F.max(p).alias("high"),
                      F.min(p).alias("low"),
                      F.max_by(p, order).alias("close"),
                      vol.alias("volume")))


def normalise_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Lower-case every column, map vendor spellings, turn NaN prices into NULL."""
    amap = dict(VENDOR_ALIASES)
    amap.update(aliases or {})
    out = df
    for c in df.columns:
        lc = c.lower().strip()
        new = amap.get(lc, lc.replace(" ", "_"))
        if new != c:
            out = out.withColumnRenamed(c, new)
    for c in PRICE_COLUMNS:
        if c in out.columns:
            out = out.withColumn(c, nan_to_null(F.col(c).cast("double")))
    if "volume" in out.columns and dict(out.dtypes)["volume"] == "string":
        out = out.withColumn("volume", F.col("volume").cast("double"))
    if "date" in out.columns:
        out = out.withColumn("date", F.to_timestamp_ntz(F.col("date").cast("string")) if
                             dict(out.dtypes)["date"] == "string" else F.col("date").cast("timestamp_ntz"))
    return out


def missing_required(columns: list[str], required: list[str] = BASE_COLUMNS) -> list[str]:
    """Required-column gate (P2): the names a table lacks; a non-empty answer skips the table."""
    have = {c.lower() for c in columns}
    return [c for c in required if c not in have]


def required_gate(df: DataFrame, required: list[str] = BASE_COLUMNS, key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """Per-ticker required-column gate (P2): a ticker whose source lacks a required column
    (read as all NULL, or absent from the table) is skipped, not an error.

    Returns (rows of passing tickers, skipped (ticker, missing) table).  One aggregate of
    non-NULL counts per ticker, combined map-side."""
    present = [c for c in required if c in df.columns]
    absent = [c for c in required if c not in df.columns]
    counts = df.groupBy(key).agg(*[F.count(F.col(c)).alias(f"_n_{c}") for c in present])
    missing = F.array_compact(F.array(*[F.when(F.col(f"_n_{c}") == 0, F.lit(c)) for c in present],
                                      *[F.lit(c) for c in absent]))
    gate = counts.select(key, missing.alias("missing"))
    skipped = gate.filter(F.size("missing") > 0)
    ok = df.join(gate.filter(F.size("missing") == 0).select(key), key, "left_semi")
    return ok, skipped
