"""DuckDB SQL fragments shared by the oracle queries (derived inputs)."""

BARS_ORDERS = """
  SELECT o_orderpriority AS ticker, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS BIGINT) AS volume
  FROM orders GROUP BY 1, 2"""

BARS_EVENTS = """
  SELECT event_type AS ticker, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, row(ts, event_id)) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM events GROUP BY 1, 2"""

BARS_LINEITEM = """
  SELECT l_returnflag || l_linestatus AS ticker, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS date,
         arg_min(l_extendedprice / l_quantity, row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity, row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2"""

BARS_SUPPLIER = """
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS date,
         arg_min(l_extendedprice / l_quantity, row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity, row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2"""


def r6(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)
