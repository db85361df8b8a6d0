"""Constituent (symbol) list operators: cleaning, day-over-day diff, count check, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A valid symbol is 1 to 5 characters, upper-case letters or digits;
# the expected size of the constituent list is 500 to 510.
SYMBOL_PATTERN = "^[0-9A-Z]{1,5}$"
SHARE_CLASS_PATTERN = "^[0-9A-Z]{1,5}([.-][A-Z])?$"
EXPECTED_MIN, EXPECTED_MAX = 500, 510


def cleaned_symbol(raw: Column) -> Column:
    return F.upper(F.trim(raw))


def clean_symbols(raw: DataFrame, symbol: str = "symbol", pos: str = "pos",
                  share_class: bool = False) -> tuple[DataFrame, DataFrame]:
    """Trim, upper-case, keep 1-5 alphanumerics, first occurrence wins.

    Returns (clean (pos, symbol), rejects (pos, raw, reason)).  The first occurrence is
    ``min(pos)`` per cleaned symbol: an aggregate, combined map-side.
    """
    pat = SHARE_CLASS_PATTERN if share_class else SYMBOL_PATTERN
    c = raw.select(F.col(pos).alias("pos"), F.col(symbol).alias("raw"),
                   cleaned_symbol(F.col(symbol)).alias("symbol"))
    valid = F.coalesce(F.col("symbol").rlike(pat), F.lit(False))
    firsts = (c.filter(valid).groupBy("symbol").agg(F.min("pos").alias("pos")))
    clean = firsts.select("pos", "symbol")
    dup = c.filter(valid).join(firsts.withColumnRenamed("pos", "_first"), "symbol") \
           .filter(F.col("pos") != F.col("_first")).select("pos", "raw", F.lit("duplicate").alias("reason"))
    bad = c.filter(~valid).select("pos", "raw", F.lit("invalid").alias("reason"))
    return clean, bad.unionByName(dup)


def symbol_diff(current: DataFrame, previous: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Added / removed symbols vs the previous list (J3): full outer join on the symbol."""
    cur = current.select(F.col(symbol).alias("symbol")).distinct().withColumn("_c", F.lit(True))
    prev = previous.select(F.col(symbol).alias("symbol")).distinct().withColumn("_p", F.lit(True))
    j = cur.join(prev, "symbol", "full_outer")
    change = F.when(F.col("_p").isNull(), F.lit("added")).when(F.col("_c").isNull(), F.lit("removed"))
    return j.select("symbol", change.alias("change")).filter(F.col("change").isNotNull())


def diff_counts(diff: DataFrame) -> DataFrame:
    """tickers_added, tickers_removed, net_change of a diff."""
    a = F.count_if(F.col("change") == "added").cast("long")
    r = F.count_if(F.col("change") == "removed").cast("long")
    return diff.agg(a.alias("tickers_added"), r.alias("tickers_removed"), (a - r).alias("net_change"))


def symbol_count_check(symbols: DataFrame, lo: int = EXPECTED_MIN, hi: int = EXPECTED_MAX,
                       symbol: str = "symbol") -> DataFrame:
    """Distinct symbol count and whether it lies in [lo, hi]."""
    n = F.count_distinct(F.col(symbol)).cast("long")
    return symbols.agg(n.alias("n_symbols"), n.between(lo, hi).alias("count_ok"))


def company_lookup(symbols: DataFrame, names: DataFrame, symbol: str = "symbol",
                   name_symbol: str = "symbol", company: str = "company_name",
                   position: str | None = None) -> DataFrame:
    """Symbol -> company name, joined on the cleaned symbol (J1); of a repeated symbol the last
    name in the order of ``position`` counts (without it, in the order of the names table's rows).  The planner picks a
    broadcast at run time only when the names table is measured small (AQE)."""
    pos = F.col(position) if position else F.monotonically_increasing_id()
    n = names.select(cleaned_symbol(F.col(name_symbol)).alias("_k"), F.col(company).alias("company_name"), pos.alias("_p"))
    n = n.groupBy("_k").agg(F.max_by("company_name", F.struct("_p", "company_name")).alias("company_name"))
    return (symbols.withColumn("_k", cleaned_symbol(F.col(symbol)))
                   .join(n, "_k", "left").drop("_k"))


def symbols_from_string(df: DataFrame, text: str, out: str = "symbol") -> DataFrame:
    """Comma-separated symbols in a text column -> one row per trimmed symbol."""
    return (df.select(F.posexplode(F.transform(F.split(F.col(text), ","), lambda s: F.trim(s)))
                       .alias("pos", out))
              .filter(F.length(F.col(out)) > 0))


def validate_symbols(df: DataFrame, symbol: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Keep rows with a usable (non-NULL, non-blank) symbol; report the rest."""
    ok = F.col(symbol).isNotNull() & (F.length(F.trim(F.col(symbol))) > 0)
    return df.filter(ok), df.filter(~ok | F.col(symbol).isNull())
