"""Registered queries: bar derivation (A22) and indicators (W1-W21) with their oracles.

Indicators run on the hourly event bars (5 tickers, every bar kept), whose prices are
small enough that 6-decimal rounding compares the exponential means exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barwright.operators import indicators as ind
from barwright.operators.history import last_rows
from barwright.operators.series import Layout
from barwright.plans import datasets as ds
from barwright.plans.catalog import r6, register
from barwright.plans.features import modular_features, with_indicators
from barwright.plans.sqlparts import BARS_EVENTS, BARS_LINEITEM, BARS_ORDERS, BARS_SUPPLIER
from barwright.plans.sqlparts import r6 as sql_r6

BASE = ["open", "high", "low", "close"]
LAY = Layout()


def _bars_sql(src: str) -> str:
    return f"SELECT ticker, date, {sql_r6(BASE)}, volume FROM ({src}) b"


@register("bars_daily_orders", _bars_sql(BARS_ORDERS))
def bars_daily_orders(spark, sf):
    return r6(ds.daily_orders(spark, sf))


@register("bars_hourly_events", _bars_sql(BARS_EVENTS))
def bars_hourly_events(spark, sf):
    return r6(ds.hourly_events(spark, sf))


@register("bars_daily_lineitem", _bars_sql(BARS_LINEITEM))
def bars_daily_lineitem(spark, sf):
    return r6(ds.daily_lineitem(spark, sf))


def _ind_sql(select: str, extra_cte: str = "", base: str = BARS_EVENTS) -> str:
    return f"""WITH RECURSIVE b AS ({base}),
s AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i,
             lag(close) OVER (PARTITION BY ticker ORDER BY date) AS pc,
             count(*) OVER (PARTITION BY ticker) AS n FROM b){extra_cte}
{select}"""


def _full(agg: str, col: str, n: int) -> str:
    w = f"(PARTITION BY ticker ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {w} = {n} THEN {agg}({col}) OVER {w} END"


def _div(a: str, b: str) -> str:
    return (f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL WHEN ({b}) = 0 THEN "
            f"(CASE WHEN ({a}) > 0 THEN 'inf'::DOUBLE WHEN ({a}) < 0 THEN '-inf'::DOUBLE END) "
            f"ELSE ({a}) / ({b}) END")


def _ema_cte(spans: dict[str, float], src: str = "close", base_cte: str = "s") -> str:
    names = list(spans)
    seed = ", ".join(f"{src} AS {n}" for n in names)
    step = ", ".join(f"(2.0/{spans[n] + 1}) * x.{src} + (1 - 2.0/{spans[n] + 1}) * e.{n}" for n in names)
    return f""",
e ({", ".join(["ticker", "i"] + names)}) AS (
  SELECT ticker, i, {seed} FROM {base_cte} WHERE i = 0
  UNION ALL
  SELECT x.ticker, x.i, {step} FROM e JOIN {base_cte} x ON x.ticker = e.ticker AND x.i = e.i + 1)"""


def _simple(name: str, levels_fn, cols_sql: dict[str, str]):
    sql = _ind_sql(f"SELECT ticker, date, {', '.join(f'round({v}, 6) AS {k}' for k, v in cols_sql.items())} FROM s")

    @register(name, sql)
    def q(spark, sf):
        out = with_indicators(ds.hourly_events(spark, sf), *levels_fn())
        return r6(out.select("ticker", "date", *cols_sql))
    return q


_simple("sma", lambda: [ind.sma(LAY, "close", 20, "sma_20"), ind.sma(LAY, "close", 50, "sma_50")],
        {"sma_20": _full("avg", "close", 20), "sma_50": _full("avg", "close", 50)})

_simple("sma_set", lambda: [ind.sma(LAY, "close", n, f"sma_{n}") for n in (5, 10, 20, 50, 200)],
        {f"sma_{n}": _full("avg", "close", n) for n in (5, 10, 20, 50, 200)})

_simple("bollinger", lambda: [ind.bollinger(LAY)],
        {"bb_middle": _full("avg", "close", 20),
         "bb_upper": f"{_full('avg', 'close', 20)} + 2 * {_full('stddev_samp', 'close', 20)}",
         "bb_lower": f"{_full('avg', 'close', 20)} - 2 * {_full('stddev_samp', 'close', 20)}"})

_simple("pct_change", lambda: [ind.pct_change(LAY, "close", 1, "price_change")],
        {"price_change": f"{_div('close', 'pc')} - 1"})

_simple("momentum", lambda: [ind.momentum(LAY, (1, 5, 10))],
        {f"momentum_{p}d": f"{_div('close', f'lag(close, {p}) OVER (PARTITION BY ticker ORDER BY i)')} - 1"
         for p in (1, 5, 10)})

_simple("volume_ratio", lambda: [ind.volume_ratio(LAY, 20)],
        {"volume_sma": _full("avg", "CAST(volume AS DOUBLE)", 20),
         "volume_ratio": _div("CAST(volume AS DOUBLE)", _full("avg", "CAST(volume AS DOUBLE)", 20))})

_TR = "CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END"
_simple("atr", lambda: [ind.atr(LAY, 14)], {"atr_14": _full("avg", f"({_TR})", 14)})

_RSI_AG = _full("avg", "CASE WHEN close - pc > 0 THEN close - pc ELSE 0 END", 14)
_RSI_AL = _full("avg", "CASE WHEN close - pc < 0 THEN pc - close ELSE 0 END", 14)
_simple("rsi", lambda: [ind.rsi(LAY, "close", 14, "rsi_14")],
        {"rsi_14": f"CASE WHEN ({_RSI_AL}) = 0 AND ({_RSI_AG}) > 0 THEN 100.0 WHEN ({_RSI_AL}) = 0 THEN NULL "
                   f"ELSE 100.0 - 100.0 / (1.0 + ({_RSI_AG}) / ({_RSI_AL})) END"})


_STOCH_K = ("100.0 * " + _div(f"close - ({_full('min', 'low', 14)})",
                              f"({_full('max', 'high', 14)}) - ({_full('min', 'low', 14)})"))


@register("stochastic", _ind_sql(f"""SELECT ticker, date, round(stoch_k, 6) AS stoch_k,
  round(CASE WHEN count(stoch_k) OVER w3 = 3 THEN avg(stoch_k) OVER w3 END, 6) AS stoch_d
FROM k WINDOW w3 AS (PARTITION BY ticker ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
                                 f",\nk AS (SELECT *, {_STOCH_K} AS stoch_k FROM s)"))
def stochastic(spark, sf):
    out = with_indicators(ds.hourly_events(spark, sf), ind.stochastic(LAY, 14, 3))
    return r6(out.select("ticker", "date", "stoch_k", "stoch_d"))


@register("bb_width_pctb", _ind_sql(f"""SELECT ticker, date,
  round({_div('bb_upper - bb_lower', 'bb_middle')}, 6) AS bb_width,
  round({_div('close - bb_lower', 'bb_upper - bb_lower')}, 6) AS bb_pctb
FROM bb""", f""",
bb AS (SELECT *, {_full('avg', 'close', 20)} AS bb_middle,
       {_full('avg', 'close', 20)} + 2 * {_full('stddev_samp', 'close', 20)} AS bb_upper,
       {_full('avg', 'close', 20)} - 2 * {_full('stddev_samp', 'close', 20)} AS bb_lower FROM s)"""))
def bb_width_pctb(spark, sf):
    out = with_indicators(ds.hourly_events(spark, sf), ind.bollinger(LAY), ind.bb_width_pctb())
    return r6(out.select("ticker", "date", "bb_width", "bb_pctb"))


@register("ema", _ind_sql("""SELECT s.ticker, s.date, round(e.ema_12, 6) AS ema_12, round(e.ema_26, 6) AS ema_26
FROM s JOIN e ON s.ticker = e.ticker AND s.i = e.i""", _ema_cte({"ema_12": 12, "ema_26": 26})))
def ema(spark, sf):
    out = with_indicators(ds.hourly_events(spark, sf), emas={"ema_12": 12, "ema_26": 26})
    return r6(out.select("ticker", "date", "ema_12", "ema_26"))


_MACD_CTE = """,
e (ticker, i, e12, e26, sig) AS (
  SELECT ticker, i, close, close, CAST(0.0 AS DOUBLE) FROM s WHERE i = 0
  UNION ALL
  SELECT x.ticker, x.i, (2.0/13) * x.close + (1 - 2.0/13) * e.e12, (2.0/27) * x.close + (1 - 2.0/27) * e.e26,
         (2.0/10) * (((2.0/13) * x.close + (1 - 2.0/13) * e.e12) - ((2.0/27) * x.close + (1 - 2.0/27) * e.e26))
           + (1 - 2.0/10) * e.sig
  FROM e JOIN s x ON x.ticker = e.ticker AND x.i = e.i + 1)"""


@register("macd", _ind_sql("""SELECT s.ticker, s.date, round(e.e12 - e.e26, 6) AS macd,
  round(e.sig, 6) AS macd_signal, round(e.e12 - e.e26 - e.sig, 6) AS macd_histogram
FROM s JOIN e ON s.ticker = e.ticker AND s.i = e.i""", _MACD_CTE))
def macd(spark, sf):
    out = with_indicators(ds.hourly_events(spark, sf), macd={})
    out = out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    return r6(out.select("ticker", "date", "macd", "macd_signal", "macd_histogram"))


_MOD_COLS = ["sma_20", "sma_50", "ema_12", "ema_26", "macd", "macd_signal", "rsi", "price_change",
             "price_change_pct", "volume_sma", "volume_ratio"]


_MOD_SQL = _ind_sql(f"""SELECT ticker, date, {sql_r6(BASE)}, volume, {sql_r6(_MOD_COLS)}
FROM (SELECT ticker, date, open, high, low, close, volume, n,
        CASE WHEN n >= 50 THEN {_full('avg', 'close', 20)} END AS sma_20,
        CASE WHEN n >= 50 THEN {_full('avg', 'close', 50)} END AS sma_50,
        CASE WHEN n >= 50 THEN e12 END AS ema_12, CASE WHEN n >= 50 THEN e26 END AS ema_26,
        CASE WHEN n >= 50 THEN e12 - e26 END AS macd, CASE WHEN n >= 50 THEN sig END AS macd_signal,
        CASE WHEN n >= 50 THEN (CASE WHEN ({_RSI_AL}) = 0 AND ({_RSI_AG}) > 0 THEN 100.0
             WHEN ({_RSI_AL}) = 0 THEN NULL ELSE 100.0 - 100.0 / (1.0 + ({_RSI_AG}) / ({_RSI_AL})) END) END AS rsi,
        CASE WHEN n >= 50 THEN {_div('close', 'pc')} - 1 END AS price_change,
        CASE WHEN n >= 50 THEN ({_div('close', 'pc')} - 1) * 100.0 END AS price_change_pct,
        CASE WHEN n >= 50 THEN {_full('avg', 'CAST(volume AS DOUBLE)', 20)} END AS volume_sma,
        CASE WHEN n >= 50 THEN {_div('CAST(volume AS DOUBLE)', _full('avg', 'CAST(volume AS DOUBLE)', 20))} END
          AS volume_ratio
      FROM j) f
WHERE n < 50 OR ({' AND '.join(f'{c} IS NOT NULL' for c in _MOD_COLS)})""",
                    _MACD_CTE + ",\nj AS (SELECT s.*, e.e12, e.e26, e.sig FROM s JOIN e ON s.ticker = e.ticker AND s.i = e.i)")


@register("features_modular", _MOD_SQL)
def features_modular(spark, sf):
    return r6(modular_features(ds.hourly_events(spark, sf)))


@register("tail30", f"""SELECT ticker, date, {sql_r6(BASE)}, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM ({BARS_ORDERS}) b) t
WHERE rn <= 30""")
def tail30(spark, sf):
    return r6(last_rows(ds.daily_orders(spark, sf), 30))


DEPTH_MIN_ROWS = 500


@register("depth_filter", f"""SELECT ticker, date, {sql_r6(BASE)}, volume FROM ({BARS_SUPPLIER}) b
WHERE ticker IN (SELECT ticker FROM ({BARS_SUPPLIER}) c GROUP BY ticker HAVING count(*) >= {DEPTH_MIN_ROWS})""")
def depth_filter(spark, sf):
    """Tickers (suppliers) with at least 500 bars keep all their bars (A1 + J2)."""
    bars = ds.daily_lineitem(spark, sf, by_supplier=True)
    deep = bars.groupBy("ticker").count().filter(F.col("count") >= DEPTH_MIN_ROWS).select("ticker")
    return r6(bars.join(deep, "ticker", "left_semi"))
