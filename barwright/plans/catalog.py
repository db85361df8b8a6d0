"""Registered queries: one Spark callable per operator, each with its DuckDB oracle SQL.

Every callable takes ``(spark, sf_dir)`` and reads the driver tables under ``sf_dir``
(or tables Spark derives from them), so its work grows with the data.  Floats are
rounded to 6 decimals on both sides (``r6``); computed columns carry the same alias
in the Spark result and in the SQL.  Oracle SQL lives in ``barwright/sql/<name>.sql``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "sql")


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: file ``sql/<name>.sql`` if any,
    else a rows-only check)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def oracle() -> dict[str, str]:
    out = dict(ORACLE)
    for name in QUERIES:
        if name in out:
            continue
        p = os.path.join(SQL_DIR, f"{name}.sql")
        if os.path.exists(p):
            with open(p) as f:
                out[name] = f.read()
    return {k: sql_round6(v) for k, v in out.items() if k in QUERIES}


def round6(c):
    """6-decimal rounding as round-half-away(x * 1e6) / 1e6 on the binary value, the same
    arithmetic as the SQL side (``sql_round6``), so ties round identically."""
    return F.round(c * F.lit(1e6), 0) / F.lit(1e6)


def sql_round6(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` of an oracle query into the ``round6`` arithmetic."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k, last_comma = 0, j + len(key), -1
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                last_comma = k
            k += 1
        if last_comma < 0 or sql[last_comma + 1:k].strip() != "6":
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        inner = sql_round6(sql[j + len(key):last_comma])
        out.append(sql[i:j])
        out.append(f"(round(({inner}) * 1000000.0) / 1000000.0)")
        i = k + 1


def r6(df: DataFrame) -> DataFrame:
    """Round every float column to 6 decimals (the oracle rule)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
