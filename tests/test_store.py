"""Landed files, the versioned history store and the streams that feed it: order of lines, own
headers, pruning, batches that fail or come again."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.operators import history as h
from barwright.operators import indicators as ind
from barwright.operators.series import Layout
from barwright.plans.features import with_indicators
from barwright.sources import fs, io, landed
from barwright.sources.store import Conflict, HistoryStore
from barwright.streaming import bars as sb


def put(root, name, text, day="2025-01-02"):
    os.makedirs(f"{root}/dt={day}", exist_ok=True)
    with open(f"{root}/dt={day}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_every_file_by_its_own_header(spark, tmp_path):
    root = str(tmp_path)
    put(root, "AAPL.csv", "Date,Open,High,Low,Close,Volume\n2025-01-01,1,2,0.5,5,10.75\n\n2025-01-02,1,2,0.5,nan,NaN\n2025-01-03,x,,1,2,3\n")
    put(root, "BRK.B.csv", "﻿1. open,2. high,3. low,4. close,5. volume,date,Stock Splits\n1,2,3,4,5,2025-01-01,\"a,b\"\n9,9,9,9\n")
    put(root, "EMPTY.csv", "")
    put(root, "HEAD.csv", "date,close\n")
    put(root, "A%20B.csv", "ticker,date,close,CLOSE\nA/B,2025-01-01 10:30:00,1,2\n")
    got = {(r.ticker, str(r.date)): r for r in landed.read_landed(spark, root).collect()}
    assert set(got) == {("AAPL", "2025-01-01 00:00:00"), ("AAPL", "2025-01-02 00:00:00"), ("AAPL", "2025-01-03 00:00:00"),
                        ("BRK.B", "2025-01-01 00:00:00"), ("BRK.B", "None"), ("A/B", "2025-01-01 10:30:00")}
    a, b, c = (got["AAPL", f"2025-01-0{i} 00:00:00"] for i in (1, 2, 3))
    assert (a.volume, a.close, b.volume, b.close) == (10.75, 5.0, None, None)
    assert (c.open, c.high, c.low, c.volume) == (None, None, 1.0, 3.0)
    x = got["BRK.B", "2025-01-01 00:00:00"]
    assert (x.open, x.close, x.volume, x.stock_splits, str(x.dt)) == (1.0, 4.0, 5.0, "a,b", "2025-01-02")
    assert got["A/B", "2025-01-01 10:30:00"].close == 1.0  # of two columns of a name the first


@pytest.mark.parametrize("files", [0, 100_000])
def test_last_line_wins_across_blocks(spark, tmp_path, monkeypatch, files):
    monkeypatch.setattr(landed, "BROADCAST_FILES", files)  # 0: the header table is joined by a shuffle
    root = str(tmp_path)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i % 50) for i in range(400)]
    for name in ("X", "Y"):
        put(root, f"{name}.csv", "date,close,volume\n" + "".join(f"{d},{i},{i + 0.5}\n" for i, d in enumerate(days)))
    put(root, "X.csv", "close,date\n-1,2020-01-03\n-2,2020-01-03\n", "2025-01-03")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")  # a file of many blocks, some in one task
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        rows = landed.read_landed(spark, root)
        assert landed.scan_lines(spark, [root]).rdd.getNumPartitions() > 8
        want = {("X" if t == 0 else "Y", str(d)): i + 0.0 for t in (0, 1) for i, d in enumerate(days)} | {("X", "2020-01-03"): -2.0}
        for n in (1, 3, 8):
            hist, outcome = h.backfill(rows.repartition(n), spark.createDataFrame([("X",), ("Y",), ("Z",)], "ticker string"))
            assert {(r.ticker, str(r.date)[:10]): r.close for r in hist.collect()} == want
            assert {r.ticker: (r.rows, r.ok, r.error) for r in outcome.collect()} == {
                "X": (50, True, None), "Y": (50, True, None), "Z": (0, False, "no data")}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_dates(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(landed.NoLandedData):
        landed.read_landed(spark, f"{root}/none")
    for day in ("2025-01-02", "2025-01-10", "2024-12-31", "latest"):
        put(root, "A.csv", f"date,close\n{day},1\n", day)
    assert landed.landed_dates(spark, root) == ["2024-12-31", "2025-01-02", "2025-01-10"]
    day = lambda d: sorted(str(r.dt) for r in landed.read_landed(spark, root, d).collect())
    assert day("latest") == ["2025-01-10"] and day(("2024-12-31", "2025-01-02")) == ["2024-12-31", "2025-01-02"]
    assert all("dt=2025-01-10" in p for p in landed.scan_lines(spark, landed.landed_paths(spark, root, "latest")).inputFiles())
    for bad in ("2025-01-0", "2025-01-03", ("2026-01-01", "2026-02-01")):
        with pytest.raises(landed.NoLandedData):
            landed.landed_paths(spark, root, bad)


def test_ticker_files(spark, tmp_path):
    root = str(tmp_path)
    rows = [("A/B", 1, 2.5), ("A/B", 2, 3.5), ("BRK.B", 1, 1.0), ("1-URGENT", 1, 7.0)]
    df = spark.createDataFrame(rows, "ticker string, line int, close double").withColumn("date", F.lit("2025-01-01"))
    landed.write_ticker_files(df, root, "2025-01-05", ["line"])
    assert sorted(f for f in os.listdir(f"{root}/dt=2025-01-05") if f[0] != ".") == ["1-URGENT.csv", "A%2FB.csv", "BRK.B.csv"]
    landed.write_ticker_files(df.where("ticker <> 'BRK.B'"), root, "2025-01-05", ["line"])  # replaced
    got = sorted((r.ticker, r.close, r._seq.row) for r in landed.read_landed(spark, root, "latest").collect())
    assert [(t, c) for t, c, _ in got] == [("1-URGENT", 7.0), ("A/B", 2.5), ("A/B", 3.5)] and got[1][2] < got[2][2]


BARS = "ticker string, date timestamp_ntz, close double, volume double"


def frame(spark, rows):
    return spark.createDataFrame([(t, d and dt.datetime.fromisoformat(d), c, v) for t, d, c, v in rows], BARS)


def content(store, **kw):
    return sorted((r.ticker, str(r.date)[:10], r.close, r.volume, r.year) for r in store.read(**kw).collect())


def test_store_merges_and_prunes(spark, tmp_path):
    store = HistoryStore(spark, f"{tmp_path}/s", buckets=3)
    assert content(store) == []
    assert store.upsert(frame(spark, [("A", "2020-01-01", 1.0, 1.5), ("B", "2021-06-01", 2.0, None), (None, "2020-01-01", 9.0, 1.0),
                                      ("A", None, 9.0, 1.0)])) == "written"
    first = {tuple(x[:2]): x[2] for x in store.manifest()["live"]}
    assert store.upsert(frame(spark, [("A", "2020-01-01", 5.0, None), ("A", "2020-01-02", 6.0, 0.25)])) == "written"
    assert content(store) == [("A", "2020-01-01", 5.0, None, 2020), ("A", "2020-01-02", 6.0, 0.25, 2020), ("B", "2021-06-01", 2.0, None, 2021)]
    second = {tuple(x[:2]): x[2] for x in store.manifest()["live"]}
    assert {k for k in second if first.get(k) != second[k]} == {k for k in second if k[0] == 2020}  # 2021 is not rewritten
    plan = store.read(years=[2020], tickers=["A"])
    assert all("/year=2020/" in f for f in plan.inputFiles()) and plan.count() == 2
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(year" in text and "EqualTo(ticker,A)" in text
    assert content(store, tickers=frame(spark, [("B", None, None, None)])) == [("B", "2021-06-01", 2.0, None, 2021)]
    assert store.upsert(frame(spark, [])) == "empty"
    assert HistoryStore(spark, f"{tmp_path}/s", buckets=99).manifest()["buckets"] == 3
    assert store.vacuum(1) == 0 or content(store)
    assert len(content(store)) == 3


def test_store_takes_new_columns(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), buckets=2)
    store.upsert(frame(spark, [("A", "2020-01-01", 1.0, 1.0)]))
    store.upsert(frame(spark, [("B", "2020-01-01", 2.0, 2.0)]).withColumn("split", F.lit("x")))
    assert sorted((r.ticker, r.split) for r in store.read().collect()) == [("A", None), ("B", "x")]


def test_batches_that_fail_or_come_again(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path), buckets=2)
    one, two = frame(spark, [("A", "2020-01-01", 1.0, 1.0)]), frame(spark, [("A", "2020-01-01", 2.0, 2.0), ("A", "2021-01-01", 3.0, 3.0)])
    assert store.upsert(one, ("s", 0)) == "written"
    real, calls = fs.create_document, []

    def lost(*args):  # the job dies before the manifest
        calls.append(args)
        raise OSError("executor and driver lost")
    monkeypatch.setattr(fs, "create_document", lost)
    with pytest.raises(OSError):
        store.upsert(two, ("s", 1))
    monkeypatch.setattr(fs, "create_document", real)
    assert calls and content(store) == [("A", "2020-01-01", 1.0, 1.0, 2020)]
    assert store.upsert(two, ("s", 1)) == "written"
    want = [("A", "2020-01-01", 2.0, 2.0, 2020), ("A", "2021-01-01", 3.0, 3.0, 2021)]
    assert content(store) == want
    assert store.upsert(one, ("s", 1)) == "skipped" and store.upsert(one, ("s", 0)) == "skipped" and content(store) == want
    assert store.upsert(one, ("other", 0)) == "written"  # another source counts for itself
    gone = store.vacuum(1)
    assert gone >= 2 and content(store) == [("A", "2020-01-01", 1.0, 1.0, 2020), want[1]]
    monkeypatch.setattr(fs, "create_document", lambda *a: False)
    with pytest.raises(Conflict):
        store.upsert(two, ("s", 2))


def test_document_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/d/x.json"
    assert fs.create_document(spark, path, "é1") and not fs.create_document(spark, path, "2")
    assert fs.read_document(spark, path) == "é1"
    assert [n for n, _ in fs.children(spark, f"{tmp_path}/d") if not n.startswith(".")] == ["x.json"]


def test_upsert_stream_repeats_a_failed_batch(spark, tmp_path, monkeypatch):
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/store"
    store = HistoryStore(spark, root, buckets=2)
    store.upsert(frame(spark, [("A", "2020-01-01", -1.0, 0.0), ("C", "2019-01-01", 7.0, 7.0)]))
    for i in range(3):
        put(landing, "A.csv", f"date,close,volume\n2020-01-01,{i},0.5\n2020-01-01,{i + 10},{i}.25\n2021-01-0{i + 1},{i},1\n", f"2025-01-0{i + 1}")
    real, fails = HistoryStore.upsert, [True]

    def flaky(self, rows, batch=None, seq=None):
        out = real(self, rows, batch, seq)
        if fails and batch == ("landing", 1):
            fails.clear()
            raise OSError("lost behind the manifest")  # the batch is stored, the stream does not know it
        return out
    monkeypatch.setattr(HistoryStore, "upsert", flaky)
    with pytest.raises(Exception, match="lost behind"):
        sb.upsert_stream(spark, landing, store, f"{tmp_path}/ckpt", files_per_batch=1)
    sb.upsert_stream(spark, landing, store, f"{tmp_path}/ckpt", files_per_batch=1)
    want = [("A", "2020-01-01", 12.0, 2.25, 2020), ("A", "2021-01-01", 0.0, 1.0, 2021), ("A", "2021-01-02", 1.0, 1.0, 2021),
            ("A", "2021-01-03", 2.0, 1.0, 2021), ("C", "2019-01-01", 7.0, 7.0, 2019)]
    assert content(store) == want
    versions = {x[0]: x[2] for x in store.manifest()["live"]}
    assert versions[2019].startswith("000000000001")  # never read nor rewritten by the stream
    sb.upsert_stream(spark, landing, store, f"{tmp_path}/ckpt2", files_per_batch=1)  # every batch again
    assert content(store) == want


def test_partitioned_files(spark, tmp_path):
    df = spark.range(4000).select(F.concat(F.lit("T"), F.col("id") % 7).alias("ticker"), (F.col("id") % 2 + 2020).cast("int").alias("year"),
                                  F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("date"))
    io.write_partitioned(df, str(tmp_path), ["year"], cluster=["ticker", "date"], splits=6)
    files = [f for f in os.listdir(f"{tmp_path}/year=2020") if f.endswith(".parquet")]
    assert len(files) >= 3
    back = io.read_history(spark, str(tmp_path), tickers=["T3"], years=[2020])
    assert back.count() == df.where("year = 2020 AND ticker = 'T3'").count() and "year" in back.columns
    text = spark._jvm.PythonSQLUtils.explainString(back._jdf.queryExecution(), "formatted")
    assert "(year#" in text.split("PartitionFilters: ")[1].splitlines()[0] and "EqualTo(ticker,T3)" in text
    io.write_partitioned(df.where("year = 2021").limit(5), str(tmp_path), ["year"], cluster=["ticker"])
    assert {r.year: r["count"] for r in io.read_history(spark, str(tmp_path)).groupBy("year").count().collect()} == {2020: 2000, 2021: 5}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def series(n, seed, blanks):
    rnd = np.random.default_rng(seed)
    close = 100 + np.cumsum(rnd.normal(size=n))
    return [None if i in blanks else float(c) for i, c in enumerate(close)]


def test_running_indicators_equal_the_batch(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    cases = {"plain": series(180, 1, ()), "gaps": series(180, 2, {5, 6, 60, *range(90, 125), 179}), "late start": series(180, 3, set(range(70))),
             "blank": [None] * 180, "short": series(4, 4, ()), "one": [5.0], "flat": [7.0] * 180}
    rows = [(t, start + dt.timedelta(hours=i), c) for t, v in cases.items() for i, c in enumerate(v)]
    rows += [("hot", start + dt.timedelta(hours=i), c) for i, c in enumerate(series(5000, 5, set(range(2000, 2020))))]
    table = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, close double")
    # small blocks: the hot ticker is spread over many of them
    lay = Layout(block_rows=256, halo_rows=64)
    want = with_indicators(table, ind.rsi(lay, "close", 14, "rsi_14"), macd={"fast_out": "ema_12", "slow_out": "ema_26"}, lay=lay)
    want = {(r.ticker, r.date): r for r in want.collect()}
    got, landing = None, f"{tmp_path}/bars"
    for a, b in ((0, 1), (1, 40), (40, 96), (96, 130), (130, 9000)):
        cut = lambda k: F.lit(start + dt.timedelta(hours=k)).cast("timestamp_ntz")
        part = table.where((F.col("date") >= cut(a)) & (F.col("date") < cut(b)))
        if a == 96:  # late bars are dropped
            part = part.unionByName(table.where(F.col("date") < cut(3)).withColumn("close", F.lit(1e6)))
        part.coalesce(1).write.mode("append").parquet(landing)
        got = sb.running_indicators(spark.readStream.schema(table.schema).parquet(landing), f"{tmp_path}/out", f"{tmp_path}/ckpt", lay)
    got = {(r.ticker, r.date): r for r in got.collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        for c in ("ema_12", "ema_26", "macd", "macd_signal", "rsi_14"):
            x, y = r[c], want[k][c]
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)), (k, c, x, y)
    carry = spark.read.schema(sb.CARRY).parquet(f"{tmp_path}/out/carry/batch=4")
    assert {r.ticker: r.rows for r in carry.collect()} == {**{t: len(v) for t, v in cases.items()}, "hot": 5000}


def test_a_running_batch_again_gives_the_same(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("A", start + dt.timedelta(hours=i), float(i % 7)) for i in range(60)]
    table = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, close double")
    _, carry = sb.continue_indicators(table.limit(40), spark.createDataFrame([], sb.CARRY))
    carry = carry.cache()
    again = [sorted(map(tuple, sb.continue_indicators(table, carry)[0].collect())) for _ in range(2)]
    assert again[0] == again[1] and len(again[0]) == 20
    out, same = sb.continue_indicators(table.limit(10), carry)  # nothing new
    assert out.count() == 0 and sorted(map(tuple, same.collect())) == sorted(map(tuple, carry.collect()))


def test_bars_with_late_and_repeated_ticks(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    tick = lambda i, minute, v: (i, "X", base + dt.timedelta(minutes=minute), v)
    schema = "id long, kind string, ts timestamp, v double"
    drops = [[tick(1, 5, 1.0), tick(1, 5, 1.0), tick(2, 50, 3.0), tick(3, 70, 2.0), tick(4, 300, 9.0)],
             [tick(5, 10, 100.0), tick(6, 250, 4.0), tick(3, 70, 2.0), tick(7, 301, 1.0)],  # 5 is late, 6 is not: its window is open
             []]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/ticks")
        read = (spark.readStream.schema(schema).parquet(f"{tmp_path}/ticks"), spark.read.schema(schema).parquet(f"{tmp_path}/ticks"))
        got = sb.drain_bars(*read, f"{tmp_path}/out", f"{tmp_path}/ckpt", "kind", "ts", "v", "id", dedupe_key="id")
        bars = sorted(((r.start - base).total_seconds() / 3600, r.open, r.high, r.low, r.close, r.volume) for r in got.collect())
        assert bars[:2] == [(0.0, 1.0, 3.0, 1.0, 3.0, 2), (1.0, 2.0, 2.0, 2.0, 2.0, 1)]
        assert bars[2:] == ([(5.0, 9.0, 9.0, 9.0, 9.0, 1)] if i == 0 else [(4.0, 4.0, 4.0, 4.0, 4.0, 1), (5.0, 9.0, 9.0, 1.0, 1.0, 2)])
