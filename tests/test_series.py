"""Series engine vs pandas: exponential means with NULL gaps across many blocks, rolling
windows across halo boundaries, positions of a skewed series."""

import datetime as _dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barwright.operators import indicators as ind
from barwright.operators.series import Layout, index_series
from barwright.plans.features import standard_features, with_indicators

SMALL = Layout(block_rows=128, halo_rows=64)


def _frame(spark, pdf):
    pdf = pdf[["ticker", "date", "open", "high", "low", "close", "volume"]].astype(
        {"open": "float64", "high": "float64", "low": "float64", "close": "float64", "volume": "int64"})
    return spark.createDataFrame(pdf, "ticker string, date timestamp_ntz, open double, high double, "
                                      "low double, close double, volume bigint")


def _walk(n, seed, nan_idx=()):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(0, 1, n))
    close[list(nan_idx)] = np.nan
    dates = pd.date_range("2000-01-01", periods=n, freq="D")
    return pd.DataFrame({"date": dates, "open": close, "high": close + 1, "low": close - 1, "close": close,
                         "volume": rng.integers(1, 1000, n)})


def test_index_positions(spark):
    pdf = pd.concat([_walk(3000, 1).assign(ticker="HOT"), _walk(7, 2).assign(ticker="COLD")])
    out = index_series(_frame(spark, pdf)).select("ticker", "date", "_i", "_n").toPandas()
    for t, g in out.groupby("ticker"):
        g = g.sort_values("date")
        assert list(g["_i"]) == list(range(len(g)))
        assert set(g["_n"]) == {len(g)}


@pytest.mark.parametrize("gaps", [[], [0, 1, 2, 500, 501] + list(range(1000, 1200)) + list(range(3000, 11000))])
def test_ema_with_nulls_many_blocks(spark, gaps):
    n = 20000
    pdf = _walk(n, 3, gaps).assign(ticker="A")
    pdf2 = _walk(300, 4).assign(ticker="B")
    both = pd.concat([pdf, pdf2])
    sdf = _frame(spark, both.astype({"close": "float64"}))
    spans = {"e2": 2, "e9": 9, "e12": 12, "e26": 26}
    out = with_indicators(sdf, emas=spans, lay=SMALL).select("ticker", "date", *spans).toPandas()
    for t, g in both.groupby("ticker"):
        g = g.sort_values("date")
        o = out[out.ticker == t].sort_values("date")
        for name, span in spans.items():
            ref = g["close"].ewm(span=span, adjust=False).mean().to_numpy()
            got = o[name].to_numpy(dtype=float)
            assert np.array_equal(np.isnan(ref), np.isnan(got)), name
            m = ~np.isnan(ref)
            assert np.max(np.abs(ref[m] - got[m]) / np.maximum(1.0, np.abs(ref[m]))) < 1e-9, name


def test_macd_signal_and_rolling_across_blocks(spark):
    pdf = pd.concat([_walk(1500, 5, [10, 700]).assign(ticker="A"), _walk(260, 6).assign(ticker="B")])
    sdf = _frame(spark, pdf)
    out = with_indicators(sdf, ind.sma(SMALL, "close", 50, "sma_50"), ind.rsi(SMALL, "close", 14, "rsi"),
                          ind.bollinger(SMALL), macd={}, lay=SMALL).toPandas()
    for t, g in pdf.groupby("ticker"):
        g = g.sort_values("date").reset_index(drop=True)
        o = out[out.ticker == t].sort_values("date").reset_index(drop=True)
        c = g.close
        e12 = c.ewm(span=12, adjust=False).mean()
        e26 = c.ewm(span=26, adjust=False).mean()
        macd = e12 - e26
        sig = macd.ewm(span=9, adjust=False).mean()
        d = c.diff()
        rsi = 100 - 100 / (1 + pd.Series(np.where(d > 0, d, 0)).rolling(14).mean()
                           / pd.Series(np.where(d < 0, -d, 0)).rolling(14).mean())
        refs = {"sma_50": c.rolling(50).mean(), "macd": macd, "macd_signal": sig, "rsi": rsi,
                "bb_middle": c.rolling(20).mean(), "bb_upper": c.rolling(20).mean() + 2 * c.rolling(20).std()}
        for k, ref in refs.items():
            ref = ref.to_numpy(dtype=float)
            got = o[k].to_numpy(dtype=float)
            assert np.array_equal(np.isnan(ref), np.isnan(got)), k
            m = ~np.isnan(ref)
            assert np.allclose(ref[m], got[m], rtol=1e-9, atol=1e-9), k


def test_rsi_edges(spark):
    n = 40
    dates = pd.date_range("2001-01-01", periods=n, freq="D")
    rising = pd.DataFrame({"ticker": "UP", "date": dates, "close": np.arange(n, dtype=float)})
    flat = pd.DataFrame({"ticker": "FLAT", "date": dates, "close": np.full(n, 5.0)})
    pdf = pd.concat([rising, flat])
    for c in ("open", "high", "low"):
        pdf[c] = pdf["close"]
    pdf["volume"] = 1
    out = with_indicators(_frame(spark, pdf[["ticker", "date", "open", "high", "low", "close", "volume"]]),
                          ind.rsi(Layout(), "close", 14, "rsi")).toPandas()
    up = out[out.ticker == "UP"].sort_values("date")["rsi"].to_numpy(dtype=float)
    assert np.isnan(up[:13]).all() and (up[13:] == 100.0).all()
    assert out[out.ticker == "FLAT"]["rsi"].isna().all()


@pytest.mark.parametrize("rows", [49, 50, 199, 200])
def test_window_boundaries(spark, rows):
    pdf = _walk(rows, 7).assign(ticker="A")
    out = standard_features(_frame(spark, pdf), tail=None).toPandas().sort_values("date")
    assert out["sma_50"].notna().sum() == max(0, rows - 49)
    assert out["sma_200"].notna().sum() == max(0, rows - 199)


def test_standard_tail_and_null_rows(spark):
    pdf = _walk(120, 8, [119, 118, 60]).assign(ticker="A")
    out = standard_features(_frame(spark, pdf), tail=30).toPandas().sort_values("date")
    kept = pdf.dropna(subset=["close"]).sort_values("date").tail(30)
    assert list(out["date"]) == list(kept["date"])


def test_tail_keeps_only_what_it_needs(spark, monkeypatch):
    from barwright.operators import series
    # several blocks, a series that ends just behind a block's start, missing rows at the end
    pdf = pd.concat([_walk(2500, 11, [2499, 2400, 2390]).assign(ticker="A"), _walk(1030, 12, [1025]).assign(ticker="B"),
                     _walk(1024, 13).assign(ticker="C"), _walk(20, 14).assign(ticker="D")])
    kept, keep = [], series.keep
    monkeypatch.setattr(series, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    whole = standard_features(_frame(spark, pdf), tail=None).toPandas().sort_values(["ticker", "date"])
    out = standard_features(_frame(spark, pdf), tail=30).toPandas().sort_values(["ticker", "date"])
    want = whole.groupby("ticker").tail(30)
    assert len(out) == 110 and list(out["date"]) == list(want["date"]) and list(out["ticker"]) == list(want["ticker"])
    for c in out.columns[2:]:
        assert np.allclose(out[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float), rtol=1e-12, atol=1e-9, equal_nan=True), c
    # the last 30 rows of each ticker and one row per 64, not every row
    assert kept[0].count() > 4500 and kept[1].count() < 110 + 4600 / 64 + 10


def test_depth_filter_switch(spark):
    pdf = pd.concat([_walk(600, 9).assign(ticker="DEEP"), _walk(100, 10).assign(ticker="SHALLOW")])
    sdf = _frame(spark, pdf)
    hist = standard_features(sdf, tail=30, min_rows=500).toPandas()
    assert set(hist.ticker) == {"DEEP"} and len(hist) == 30
    literal = standard_features(sdf, tail=30, min_rows=500, depth_on="output")
    assert literal.count() == 0


def test_ranged_index_hot_key(spark):
    from barwright.operators.series import index_series_ranged
    hot = spark.range(0, 50000).select(F.lit("HOT").alias("k"), (F.col("id") % 977).alias("t"), F.col("id").alias("tb"))
    cold = spark.range(0, 30).select(F.lit("COLD").alias("k"), F.col("id").alias("t"), F.col("id").alias("tb"))
    out = index_series_ranged(hot.unionByName(cold), "k", "t", ["tb"], parts=16)
    pdf = out.toPandas()
    for k, g in pdf.groupby("k"):
        g = g.sort_values(["t", "tb"])
        assert list(g["_i"]) == list(range(len(g)))
        assert set(g["_n"]) == {len(g)}


def test_block_table_two_level(spark, monkeypatch):
    from barwright.operators import series as se
    monkeypatch.setattr(se, "SUPER_BLOCKS", 3)
    lay = Layout(block_rows=64, halo_rows=16)
    rng = np.random.default_rng(0)
    n = 64 * 20 + 7
    close = np.where(rng.random(n) < 0.7, np.nan, 1.0)
    close[200:900] = np.nan
    pdf = pd.DataFrame({"ticker": "A", "date": pd.date_range("2000-01-01", periods=n, freq="D"), "close": close})
    df = spark.createDataFrame(pdf, "ticker string, date timestamp_ntz, close double")
    bt = se.block_table(se.block_layout(index_series(df), lay), lay, "close",
                        F.col("close").isNotNull()).toPandas()
    obs = np.where(~np.isnan(close))[0]
    for _, r in bt.iterrows():
        start = int(r["_blk"]) * 64
        end = min(n, start + 64)
        prev = obs[obs < start]
        assert (None if pd.isna(r["_pobs_blk"]) else int(r["_pobs_blk"])) == (int(prev.max()) if len(prev) else None)
        assert int(r["_kafter"]) == int((obs >= end).sum())


def test_hot_ticker_is_split_into_bounded_blocks(spark):
    from barwright.operators.series import block_layout
    lay = Layout(block_rows=128, halo_rows=32)
    pdf = pd.concat([_walk(5000, 11).assign(ticker="HOT"), _walk(40, 12).assign(ticker="COLD")])
    layout = block_layout(index_series(_frame(spark, pdf)), lay)
    sizes = layout.groupBy("ticker", "_blk").count().toPandas()
    hot = sizes[sizes.ticker == "HOT"]
    assert len(hot) == -(-5000 // 128)                       # one window partition per block
    assert hot["count"].max() <= 128 + 32                      # own rows + halo, never the ticker
    own = layout.filter("_h = 0").count()
    assert own == 5040                                         # halo copies are extra, rows kept whole


def _flat(spark, closes, volumes):
    return spark.createDataFrame([("A", _dt.datetime(2024, 1, 1) + _dt.timedelta(days=i), c, v)
                                  for i, (c, v) in enumerate(zip(closes, volumes))],
                                 "ticker string, date timestamp_ntz, close double, volume double")


def test_sma_is_one_arithmetic_for_every_length_and_scale(spark):
    from barwright.operators import indicators as ind
    from barwright.operators.series import Layout, block_layout, index_series
    for scale in (3e-13, 1.23456789e-08, 1e27):
        lay = Layout.reaching(250)
        df = block_layout(index_series(_flat(spark, [scale] * 260, [0.5] * 260)), lay)
        out = ind.apply_levels(df, *(ind.sma(lay, "close", n, f"s{n}") for n in (20, 50, 250)), ind.volume_ratio(lay, 20))
        last = out.orderBy("_i").collect()[-1]
        assert all(abs(last[f"s{n}"] / scale - 1) < 1e-12 for n in (20, 50, 250))
        assert last.volume_sma == 0.5 and last.volume_ratio == 1.0


def test_keep_last_is_the_last_of_the_sequence_however_partitioned(spark):
    from barwright.operators import history as h
    # closes fall along the sequence: the last one is the smallest
    src = spark.range(500).selectExpr("'A' AS ticker", "DATE'2024-01-01' AS date", "CAST(500 - id AS DOUBLE) AS close",
                                      "struct(DATE'2024-01-02' AS dt, 'f' AS path, id AS row) AS seq")
    for n in (1, 3, 8):
        assert [r.close for r in h.upsert_keep_last([src.repartition(n)], seq="seq").collect()] == [1.0]
        old = src.drop("seq").limit(1)
        assert [r.close for r in h.upsert_keep_last([old, src.repartition(n)], seq="seq").collect()] == [1.0]
    with pytest.raises(ValueError):
        h.upsert_keep_last([src], seq="place")
