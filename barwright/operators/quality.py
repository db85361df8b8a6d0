"""Data-quality operators: null / numeric / duplicate profiles, schema checks, sampling,
rule evaluation.  Each is one aggregate pass (or a small number of them) over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.session import materialize

#: digests of 16 bytes that are broadcast at most
BROADCAST_DIGESTS = 1_000_000
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def _missing(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column (A5): (column, missing, missing_pct), one aggregate pass
    then an unpivot of its single row."""
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_missing(f)).alias(f"m{j}") for j, f in enumerate(fields)])
    rows = F.col("_rows")
    stack = F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"),
                                        F.col(f"m{j}").cast("long").alias("missing"))
                               for j, f in enumerate(fields)]))
    return (agg.select(rows, stack)
               .select("column", "missing",
                       F.when(rows > 0, F.round(F.col("missing") * 100.0 / rows, 6)).alias("missing_pct")))


def null_pct(df: DataFrame) -> DataFrame:
    """Table-wide missing percentage = missing cells / (rows x columns) x 100 (A6); NULL for 0 rows."""
    fields = df.schema.fields
    total = None
    for f in fields:
        term = F.count_if(_missing(f))
        total = term if total is None else total + term
    rows = F.count(F.lit(1))
    return df.agg(rows.cast("long").alias("rows"), F.lit(len(fields)).cast("long").alias("columns"),
                  total.cast("long").alias("missing_cells"),
                  F.when(rows > 0, total * 100.0 / (rows * F.lit(len(fields)))).alias("missing_pct"))


def numeric_profile(df: DataFrame) -> DataFrame:
    """min / max / mean of each numeric column (A7), one row per column."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    aggs = []
    for j, f in enumerate(fields):
        c = F.col(f"`{f.name}`").cast("double")
        c = F.when(~F.isnan(c), c)
        aggs += [F.min(c).alias(f"mn{j}"), F.max(c).alias(f"mx{j}"), F.avg(c).alias(f"av{j}")]
    one = df.agg(*aggs)
    stack = F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"mn{j}").alias("min"),
                                        F.col(f"mx{j}").alias("max"), F.col(f"av{j}").alias("mean"))
                               for j, f in enumerate(fields)]))
    return one.select(stack)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Fully duplicated rows beyond the first (U4): sum(n - 1) over groups of equal rows.

    Only a 128-bit digest of each row is shuffled, counted map-side; rows whose digest occurs twice
    are then compared whole, so equal digests of different rows could not count as duplicates."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    digest = (F.xxhash64(*cols, F.lit(0)).alias("_a"), F.xxhash64(F.lit(1), *cols).alias("_b"))
    pairs = df.select(*digest).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    twice = materialize(pairs.where("_n > 1"))
    keys = twice.select("_a", "_b")
    if twice.count() <= BROADCAST_DIGESTS:  # otherwise both sides are shuffled
        keys = F.broadcast(keys)
    groups = df.select("*", *digest).join(keys, ["_a", "_b"], "left_semi").groupBy("_a", "_b", *cols).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"), F.count(F.lit(1)).alias("g"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("r"))
    # two one-row tables side by side
    return groups.join(df.agg(F.count(F.lit(1)).alias("n"))).select(
        "duplicate_rows", (F.col("n") - F.col("r") + F.col("g")).cast("long").alias("distinct_rows"))


def expected_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """Expected columns and whether the table has them (J4): (column, present)."""
    have = {c.lower() for c in df.columns}
    spark = df.sparkSession
    return spark.createDataFrame([(c, c.lower() in have) for c in expected],
                                 "column string, present boolean")


def validate_frame(df: DataFrame, required: list[str], min_rows: int = 0) -> DataFrame:
    """Required columns present, enough rows, no NULL or NaN in required columns (Q1).
    One aggregate; returns (check, ok, detail) rows; all ok -> the frame passes."""
    missing = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(_missing(df.schema[c])).alias(f"n{j}")
                                                 for j, c in enumerate(present)]
    one = df.agg(*aggs)
    checks = [F.struct(F.lit("required_columns").alias("check"), F.lit(not missing).alias("ok"),
                       F.lit(",".join(missing)).alias("detail")),
              F.struct(F.lit("min_rows").alias("check"), (F.col("_rows") >= min_rows).alias("ok"),
                       F.col("_rows").cast("string").alias("detail"))]
    for j, c in enumerate(present):
        checks.append(F.struct(F.lit(f"nulls:{c}").alias("check"), (F.col(f"n{j}") == 0).alias("ok"),
                               F.col(f"n{j}").cast("string").alias("detail")))
    return one.select(F.inline(F.array(*checks)))


def sample_fixed(df: DataFrame, n: int, key: list[str], seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """Repeatable sample of ``n`` rows (T4): the n smallest hashes of (seed, key); capped at
    the row count by construction.  Independent of partitioning.  ``method="md5"`` hashes
    the text ``seed|k1|k2...`` (slower, but reproducible by any engine)."""
    if method == "md5":
        h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    else:
        h = F.xxhash64(F.lit(seed), *[F.col(k) for k in key])
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


# ---------------------------------------------------------------------------
# rule evaluation (Q4-Q7)
# ---------------------------------------------------------------------------

SEVERITY = {"healthy": 0, "warning": 1, "critical": 2}


def evaluate_rules(facts: DataFrame, rules: list[tuple[str, Column, str, str]],
                   last_rule_wins: bool = False) -> DataFrame:
    """Evaluate (name, condition, severity, text) rules on each fact row; ``text`` is a string
    or a Column (a message built from the facts).

    Output per fact row: status (max severity, or with ``last_rule_wins`` the severity of
    the last firing rule, as in the literal report code), fired rule names and texts.
    """
    fired = F.array(*[F.when(cond, F.struct(F.lit(j).alias("ord"), F.lit(name).alias("rule"),
                                            F.lit(SEVERITY[sev]).alias("sev"),
                                            (text if isinstance(text, Column) else F.lit(text)).alias("text")))
                      for j, (name, cond, sev, text) in enumerate(rules)])
    fired = F.filter(fired, lambda x: x.isNotNull())
    names = {v: k for k, v in SEVERITY.items()}
    sev_expr = (F.try_element_at(fired, F.lit(-1))["sev"] if last_rule_wins
                else F.array_max(F.transform(fired, lambda x: x["sev"])))
    sev_expr = F.coalesce(sev_expr, F.lit(0))
    status = F.when(sev_expr == 2, F.lit(names[2])).when(sev_expr == 1, F.lit(names[1])).otherwise(F.lit(names[0]))
    return facts.select("*", status.alias("status"),
                        F.transform(fired, lambda x: x["rule"]).alias("rules_fired"),
                        F.array_distinct(F.transform(fired, lambda x: x["text"])).alias("recommendations"))
