"""Bars derived from the driver tables (A22), and table loading.

The driver tables hold no price bars, so bars are aggregated from them:

* ``daily_orders``: ticker = order priority, one bar per order date, price = total price,
  volume = orders; ties inside a day broken by order key.
* ``hourly_events``: ticker = event type, one bar per hour, price = value, volume = events.
* ``daily_lineitem``: ticker = return flag || line status, one bar per ship date,
  price = extended price / quantity, volume = sum of quantity.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators.bars import ohlcv_bars

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return ohlcv_bars(o, "o_orderpriority", "o_orderdate", "o_totalprice", None, "day", "o_orderkey")


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return ohlcv_bars(e, "event_type", "ts", "value", None, "hour", "event_id")


def daily_lineitem(spark: SparkSession, sf_dir: str, by_supplier: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ticker = (F.col("l_suppkey").cast("string") if by_supplier
              else F.concat(F.col("l_returnflag"), F.col("l_linestatus")))
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    bars = ohlcv_bars(li, ticker, "l_shipdate", price, "l_quantity", "day",
                      ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])
    return bars.withColumn("volume", F.col("volume").cast("bigint"))  # quantities are whole numbers
