"""Registered feature-stage queries (bars, indicators, profiles)."""

from __future__ import annotations

from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register
from barwright.plans.features import standard_features
from barwright.plans.sqlparts import BARS_ORDERS, BARS_SUPPLIER


@register("features_standard")
def features_standard(spark, sf_dir):
    """Standard profile on daily order bars, last 30 rows per ticker (the flagship)."""
    return r6(standard_features(ds.daily_orders(spark, sf_dir), tail=30))


def _features_sql(bars_sql: str) -> str:
    """The standard-profile oracle over any bar source (recursive CTE for the exponential means)."""
    with open(__file__.replace("q_features.py", "../sql/features_standard.sql")) as f:
        sql = f.read()
    start = sql.index("bars AS (") + len("bars AS (")
    end = sql.index("),\ns AS (")
    return sql[:start] + bars_sql + "\n" + sql[end:]


@register("features_suppliers", _features_sql(BARS_SUPPLIER))
def features_suppliers(spark, sf_dir):
    """Standard profile over daily bars of every supplier (100 tickers at sf0.01, 1,000 at
    sf0.1), last 30 rows per ticker: the many-ticker shape of the feature stage."""
    return r6(standard_features(ds.daily_lineitem(spark, sf_dir, by_supplier=True), tail=30))


@register("features_shape", """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT ticker) AS BIGINT) AS tickers,
  CAST(17 AS BIGINT) AS columns, count(DISTINCT ticker) = 503 AS tickers_ok, CAST(10 AS BIGINT) AS features_generated
FROM (SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM (""" + BARS_ORDERS + """) b) t
WHERE rn <= 30""")
def features_shape(spark, sf_dir):
    """Shape section of the feature-table profile (Q2) and features generated (A10)."""
    from pyspark.sql import functions as F
    from barwright.operators.reports import features_generated, features_profile
    feats = standard_features(ds.daily_orders(spark, sf_dir), tail=30)
    prof = features_profile(feats, [])
    return prof["shape"].select("rows", "tickers", "columns", "tickers_ok",
                                F.lit(features_generated(feats)).cast("long").alias("features_generated"))


@register("features_store", _features_sql(BARS_ORDERS))
def features_store(spark, sf_dir):
    """Standard features written for one processing date (K1: dt= partition, dynamic
    overwrite) and read back."""
    from barwright.session import scratch_dir
    from barwright.sources import io
    root = scratch_dir(spark, "processed")
    feats = standard_features(ds.daily_orders(spark, sf_dir), tail=30)
    io.write_features(feats, root, "2001-08-01")
    back = spark.read.parquet(root).filter("dt = DATE'2001-08-01'").drop("dt")
    return r6(back)
