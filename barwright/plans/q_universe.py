"""Registered queries: symbol cleaning, diff, count check, company lookup.

Raw symbols are derived from ``customer`` rows: a segment prefix plus the nation key,
sometimes lower-cased, padded with spaces, dotted or too long, so every cleaning rule
fires.  The "previous" list uses customers with balance below 5000, the "current"
list those with a non-negative balance.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import universe as u
from barwright.plans import datasets as ds
from barwright.plans.catalog import register

RAW_SQL = """SELECT c_custkey AS pos, c_acctbal AS bal,
  CASE WHEN c_acctbal < 0 THEN lower(substr(c_mktsegment, 1, 2) || CAST(c_nationkey AS VARCHAR))
       WHEN c_acctbal > 9000 THEN substr(c_mktsegment, 1, 2) || '.' || CAST(c_nationkey AS VARCHAR)
       WHEN c_acctbal > 8000 THEN substr(c_mktsegment, 1, 4) || CAST(c_nationkey AS VARCHAR)
       ELSE ' ' || substr(c_mktsegment, 1, 2) || CAST(c_nationkey AS VARCHAR) || ' ' END AS symbol
FROM customer"""

CLEAN_SQL = f"""SELECT min(pos) AS pos, symbol FROM (
  SELECT pos, bal, upper(trim(symbol)) AS symbol FROM ({RAW_SQL}) r) c
WHERE regexp_full_match(symbol, '[0-9A-Z]{{1,5}}') GROUP BY symbol"""


def raw_symbols(spark, sf):
    c = ds.table(spark, sf, "customer")
    seg2 = F.substring("c_mktsegment", 1, 2)
    nk = F.col("c_nationkey").cast("string")
    sym = (F.when(F.col("c_acctbal") < 0, F.lower(F.concat(seg2, nk)))
            .when(F.col("c_acctbal") > 9000, F.concat(seg2, F.lit("."), nk))
            .when(F.col("c_acctbal") > 8000, F.concat(F.substring("c_mktsegment", 1, 4), nk))
            .otherwise(F.concat(F.lit(" "), seg2, nk, F.lit(" "))))
    return c.select(F.col("c_custkey").alias("pos"), F.col("c_acctbal").alias("bal"), sym.alias("symbol"))


@register("symbol_clean", CLEAN_SQL)
def symbol_clean(spark, sf):
    clean, _ = u.clean_symbols(raw_symbols(spark, sf))
    return clean


@register("symbol_rejects", f"""WITH c AS (SELECT pos, symbol AS raw, upper(trim(symbol)) AS symbol FROM ({RAW_SQL}) r),
v AS (SELECT *, regexp_full_match(symbol, '[0-9A-Z]{{1,5}}') AS ok FROM c),
f AS (SELECT symbol, min(pos) AS first_pos FROM v WHERE ok GROUP BY symbol)
SELECT pos, raw, 'invalid' AS reason FROM v WHERE NOT ok
UNION ALL
SELECT v.pos, v.raw, 'duplicate' AS reason FROM v JOIN f ON v.symbol = f.symbol WHERE v.ok AND v.pos <> f.first_pos""")
def symbol_rejects(spark, sf):
    _, rejects = u.clean_symbols(raw_symbols(spark, sf))
    return rejects


def _cleaned(where_sql: str) -> str:
    return f"""SELECT DISTINCT upper(trim(symbol)) AS symbol FROM ({RAW_SQL}) r
  WHERE {where_sql} AND regexp_full_match(upper(trim(symbol)), '[0-9A-Z]{{1,5}}')"""


@register("symbol_diff", f"""WITH cur AS ({_cleaned('bal >= 0')}), prev AS ({_cleaned('bal < 5000')})
SELECT symbol, 'added' AS change FROM cur WHERE symbol NOT IN (SELECT symbol FROM prev)
UNION ALL
SELECT symbol, 'removed' AS change FROM prev WHERE symbol NOT IN (SELECT symbol FROM cur)""")
def symbol_diff(spark, sf):
    raw = raw_symbols(spark, sf)
    cur, _ = u.clean_symbols(raw.filter(F.col("bal") >= 0))
    prev, _ = u.clean_symbols(raw.filter(F.col("bal") < 5000))
    return u.symbol_diff(cur, prev)


@register("symbol_diff_counts", f"""WITH cur AS ({_cleaned('bal >= 0')}), prev AS ({_cleaned('bal < 5000')}),
d AS (SELECT symbol, 'added' AS change FROM cur WHERE symbol NOT IN (SELECT symbol FROM prev)
      UNION ALL SELECT symbol, 'removed' FROM prev WHERE symbol NOT IN (SELECT symbol FROM cur))
SELECT CAST(count(*) FILTER (WHERE change = 'added') AS BIGINT) AS tickers_added,
       CAST(count(*) FILTER (WHERE change = 'removed') AS BIGINT) AS tickers_removed,
       CAST(count(*) FILTER (WHERE change = 'added') - count(*) FILTER (WHERE change = 'removed') AS BIGINT)
         AS net_change FROM d""")
def symbol_diff_counts(spark, sf):
    return u.diff_counts(symbol_diff(spark, sf))


@register("symbol_count_check", f"""SELECT CAST(count(DISTINCT symbol) AS BIGINT) AS n_symbols,
  count(DISTINCT symbol) BETWEEN 500 AND 510 AS count_ok FROM ({CLEAN_SQL}) c""")
def symbol_count_check(spark, sf):
    clean, _ = u.clean_symbols(raw_symbols(spark, sf))
    return u.symbol_count_check(clean)


@register("company_lookup", """SELECT t.symbol, n.company_name FROM
  (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol FROM lineitem) t
  LEFT JOIN (SELECT upper(trim(CAST(s_suppkey AS VARCHAR))) AS k, max_by(s_name, s_suppkey) AS company_name
             FROM supplier GROUP BY 1) n ON upper(trim(t.symbol)) = n.k""")
def company_lookup(spark, sf):
    """Supplier-key tickers of lineitem -> supplier name."""
    tick = ds.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("symbol")).distinct()
    names = ds.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"),
                                                   F.col("s_name").alias("company_name"), "s_suppkey")
    return u.company_lookup(tick, names, position="s_suppkey")


@register("symbols_from_string", """SELECT pos, symbol FROM (
  SELECT CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, unnest(parts) AS symbol FROM (
    SELECT list_transform(string_split(string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment), ','),
                          lambda x: trim(x)) AS parts FROM customer) a) b
WHERE length(symbol) > 0""")
def symbols_from_string(spark, sf):
    """Comma-separated symbol text (S12), built from the customer segments."""
    c = ds.table(spark, sf, "customer")
    txt = c.agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("s"))
    return u.symbols_from_string(txt, "s")
