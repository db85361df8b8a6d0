"""Registered queries: null / numeric / duplicate profiles, frame validation, sampling.

Profiles run on ``documents`` left-joined to ``labels`` (unlabelled documents give NULL
labels) and on ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import quality as qy
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register

DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
DOC_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]


def labelled_docs(spark, sf):
    d = ds.table(spark, sf, "documents")
    lab = ds.table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left").select(*DOC_COLS)


@register("null_profile", "WITH t AS (" + DOC_SQL + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing, "
    f"round(CASE WHEN count(*) > 0 THEN (count(*) - count({c})) * 100.0 / count(*) END, 6) AS missing_pct FROM t"
    for c in DOC_COLS))
def null_profile(spark, sf):
    return r6(qy.null_profile(labelled_docs(spark, sf)))


@register("null_pct", "WITH t AS (" + DOC_SQL + ")\nSELECT CAST(count(*) AS BIGINT) AS rows, "
          f"CAST({len(DOC_COLS)} AS BIGINT) AS columns, CAST(" +
          " + ".join(f"(count(*) - count({c}))" for c in DOC_COLS) + " AS BIGINT) AS missing_cells, "
          "round(CASE WHEN count(*) > 0 THEN (" + " + ".join(f"(count(*) - count({c}))" for c in DOC_COLS) +
          f") * 100.0 / (count(*) * {len(DOC_COLS)}) END, 6) AS missing_pct FROM t")
def null_pct(spark, sf):
    return r6(qy.null_pct(labelled_docs(spark, sf)))


@register("numeric_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(min(CAST({c} AS DOUBLE)), 6) AS min, round(max(CAST({c} AS DOUBLE)), 6) AS max, "
    f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean FROM lineitem" for c in LI_NUM))
def numeric_profile(spark, sf):
    li = ds.table(spark, sf, "lineitem").select(*LI_NUM, "l_returnflag")
    return r6(qy.numeric_profile(li))


@register("duplicate_rows", """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
  CAST(count(*) AS BIGINT) AS distinct_rows FROM (SELECT text, lang, count(*) AS n FROM documents GROUP BY 1, 2) g""")
def duplicate_rows(spark, sf):
    """Exact copies among documents (text and language), beyond the first (U4)."""
    return qy.duplicate_rows(ds.table(spark, sf, "documents").select("text", "lang"))


@register("validate_frame", """SELECT 'required_columns' AS "check", true AS ok, '' AS detail
UNION ALL SELECT 'min_rows', count(*) >= 1, CAST(count(*) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'nulls:l_orderkey', count(*) - count(l_orderkey) = 0, CAST(count(*) - count(l_orderkey) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'nulls:l_shipdate', count(*) - count(l_shipdate) = 0, CAST(count(*) - count(l_shipdate) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'nulls:l_extendedprice', count(*) - count(l_extendedprice) = 0,
  CAST(count(*) - count(l_extendedprice) AS VARCHAR) FROM lineitem""")
def validate_frame(spark, sf):
    """Required columns, at least one row, no NULLs in required columns (Q1)."""
    li = ds.table(spark, sf, "lineitem")
    return qy.validate_frame(li, ["l_orderkey", "l_shipdate", "l_extendedprice"], 1)


@register("sample_fixed", """SELECT * EXCLUDE (h) FROM (
  SELECT *, md5('42|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|'
                || CAST(l_partkey AS VARCHAR)) AS h FROM lineitem) t
ORDER BY h, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def sample_fixed(spark, sf):
    """Repeatable 10-row sample of lineitem by a seeded hash (T4) - the limit is the feature."""
    return qy.sample_fixed(ds.table(spark, sf, "lineitem"), 10, ["l_orderkey", "l_linenumber", "l_partkey"], 42,
                           method="md5")


@register("head10", """SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_shipdate, l_extendedprice LIMIT 10""")
def head10(spark, sf):
    """The first 10 rows in key order (T2); the limit is the feature."""
    li = ds.table(spark, sf, "lineitem")
    return li.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                      "l_extendedprice").limit(10)


@register("row_counts", """SELECT CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS tickers,
  CAST(count(*) AS BIGINT) AS total_rows, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders""")
def row_counts(spark, sf):
    """Distinct tickers, total rows, date range."""
    o = ds.table(spark, sf, "orders")
    return o.agg(F.count_distinct("o_orderpriority").cast("long").alias("tickers"),
                 F.count(F.lit(1)).cast("long").alias("total_rows"),
                 F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))
