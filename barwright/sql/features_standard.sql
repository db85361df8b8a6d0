WITH RECURSIVE bars AS (
  SELECT o_orderpriority AS ticker, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM orders GROUP BY 1, 2
),
s AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM bars
),
e AS (
  SELECT ticker, i, close AS e12, close AS e26, CAST(0.0 AS DOUBLE) AS sig FROM s WHERE i = 0
  UNION ALL
  SELECT s.ticker, s.i,
         (2.0/13) * s.close + (1 - 2.0/13) * e.e12,
         (2.0/27) * s.close + (1 - 2.0/27) * e.e26,
         (2.0/10) * (((2.0/13) * s.close + (1 - 2.0/13) * e.e12) - ((2.0/27) * s.close + (1 - 2.0/27) * e.e26))
           + (1 - 2.0/10) * e.sig
  FROM e JOIN s ON s.ticker = e.ticker AND s.i = e.i + 1
),
r AS (
  SELECT s.*, close - lag(close) OVER (PARTITION BY ticker ORDER BY i) AS d,
    CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END AS sma_50,
    CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END AS sma_200,
    CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS bb_middle,
    CASE WHEN count(close) OVER w20 = 20 THEN stddev_samp(close) OVER w20 END AS bb_std
  FROM s
  WINDOW w50 AS (PARTITION BY ticker ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY ticker ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY ticker ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
),
g AS (
  SELECT r.*,
    CASE WHEN count(*) OVER w14 = 14 THEN avg(CASE WHEN d > 0 THEN d ELSE 0 END) OVER w14 END AS ag,
    CASE WHEN count(*) OVER w14 = 14 THEN avg(CASE WHEN d < 0 THEN -d ELSE 0 END) OVER w14 END AS al
  FROM r
  WINDOW w14 AS (PARTITION BY ticker ORDER BY i ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
)
SELECT g.ticker, g.date, round(g.open, 6) AS open, round(g.high, 6) AS high, round(g.low, 6) AS low,
       round(g.close, 6) AS close, g.volume,
       round(g.sma_50, 6) AS sma_50, round(g.sma_200, 6) AS sma_200, round(e.e26, 6) AS ema_26,
       round(e.e12 - e.e26, 6) AS macd, round(e.sig, 6) AS macd_signal,
       round(e.e12 - e.e26 - e.sig, 6) AS macd_histogram,
       round(CASE WHEN g.al = 0 AND g.ag > 0 THEN 100.0
                  WHEN g.al = 0 THEN NULL
                  ELSE 100.0 - 100.0 / (1.0 + g.ag / g.al) END, 6) AS rsi_14,
       round(g.bb_middle, 6) AS bb_middle, round(g.bb_middle + 2 * g.bb_std, 6) AS bb_upper,
       round(g.bb_middle - 2 * g.bb_std, 6) AS bb_lower
FROM g JOIN e ON g.ticker = e.ticker AND g.i = e.i
WHERE g.i >= g.n - 30
