"""Sources on files written as the pipeline lands them: per-ticker CSVs, JSON run log with
nested checkpoints, stage metadata; and the modular profile's gate with uneven tickers."""

import json
import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from barwright.operators import runs as r
from barwright.plans.features import MODULAR_COLUMNS, modular_features
from barwright.sources import io, landed


def test_read_landed_ticker_files(spark):
    root = tempfile.mkdtemp(prefix="bw-raw-")
    day = os.path.join(root, "dt=2025-01-16")
    os.makedirs(day)
    pd.DataFrame({"Date": ["2025-01-15", "2025-01-16"], "Open": [100, 105], "High": [110, 115], "Low": [90, 95],
                  "Close": [105, 110], "Volume": [1000000, 1200000]}).to_csv(os.path.join(day, "AAPL.csv"), index=False)
    pd.DataFrame({"Date": ["2025-01-16"], "Open": [1], "High": [2], "Low": [0.5], "Close": [1.5],
                  "Volume": [10]}).to_csv(os.path.join(day, "MSFT.csv"), index=False)
    got = landed.read_landed(spark, root).orderBy("ticker", "date").collect()
    assert [(x.ticker, str(x.date)[:10], x.close, x.volume) for x in got] == [
        ("AAPL", "2025-01-15", 105.0, 1000000), ("AAPL", "2025-01-16", 110.0, 1200000), ("MSFT", "2025-01-16", 1.5, 10)]
    assert landed.landed_dates(spark, root) == ["2025-01-16"]
    with pytest.raises(landed.NoLandedData):
        landed.read_landed(spark, root, dt="2025-01-17")


def test_run_log_json_and_rollup(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="bw-runs-"), "runs.json")
    runs = [{"run_id": "daily_1", "start_time": "2025-07-28T01:00:00", "mode": "daily", "is_test": False,
             "status": "completed", "end_time": "2025-07-28T01:10:00", "exit_code": 0, "error_message": None,
             "retry_count": 0, "max_retries": 3,
             "checkpoints": [{"timestamp": "2025-07-28T01:01:00", "stage": "fetch", "tickers_processed": 10,
                              "total_tickers": 20, "progress_percent": 50.0, "elapsed_seconds": 60.0,
                              "estimated_remaining": 60.0, "status": "running", "error_message": None},
                             {"timestamp": "2025-07-28T01:02:00", "stage": "features", "tickers_processed": 20,
                              "total_tickers": 20, "progress_percent": 100.0, "elapsed_seconds": 120.0,
                              "estimated_remaining": 0.0, "status": "completed", "error_message": None}]},
            {"run_id": "weekly_1", "start_time": "2025-07-27T01:00:00", "mode": "weekly", "is_test": False,
             "status": "failed", "end_time": "2025-07-27T02:00:00", "exit_code": 1,
             "error_message": "fetch_data failed. timeout; retry", "retry_count": 1, "max_retries": 3,
             "checkpoints": []}]
    with open(path, "w") as f:
        json.dump(runs, f)
    log = io.read_json_doc(spark, path, r.RUN_LOG)
    rolled = r.stage_rollup(log).orderBy("timestamp").collect()
    assert [(x.run_id, x.stage, x.progress_percent) for x in rolled] == [("daily_1", "fetch", 50.0),
                                                                         ("daily_1", "features", 100.0)]
    typed = r.runs_from_log(log)
    s = r.run_stats(typed).collect()[0]
    assert (s.total_runs, s.successful_runs, s.failed_runs, s.retried_runs) == (2, 1, 1, 1)
    assert abs(s.average_runtime_seconds - (600 + 3600) / 2) < 1e-9
    assert [x.error_key for x in r.error_distribution(typed).collect()] == ["fetch_data failed"]


def test_stage_metadata_and_newest(spark):
    base = tempfile.mkdtemp(prefix="bw-meta-")
    roots = {}
    for stage, payload in {"fetch": {"status": "success", "tickers_processed": 3, "failed_tickers": []},
                           "features": {"status": "partial_success", "features_generated": 10,
                                        "failed_tickers": ["ERROR"]}}.items():
        d = os.path.join(base, stage, "dt=2025-07-28")
        os.makedirs(d)
        with open(os.path.join(d, "metadata.json"), "w") as f:
            json.dump(payload, f)
        roots[stage] = os.path.join(base, stage)
    meta = io.stage_metadata(spark, roots, "2025-07-28")
    got = {x.stage: x.status for x in meta.collect()}
    assert got == {"fetch": "success", "features": "partial_success"}
    files = spark.createDataFrame([("daily", "a", 1), ("daily", "b", 3), ("daily", "c", 2), ("summary", "d", 1)],
                                  "kind string, path string, modified int")
    newest = {(x.kind, x.path) for x in io.newest_per_type(files, "kind", 2).collect()}
    assert newest == {("daily", "b"), ("daily", "c"), ("summary", "d")}


def test_modular_gate_uneven_tickers(spark):
    rows = []
    for t, n in (("SHORT", 30), ("LONG", 120)):
        for k in range(n):
            c = float(100 + np.sin(k / 3.0) * 5 + k * 0.1)
            rows.append((t, (pd.Timestamp("2020-01-01") + pd.Timedelta(days=k)).to_pydatetime(), c, c + 1, c - 1, c,
                         1000 + k))
    rows.append(("LONG", pd.Timestamp("2019-12-01").to_pydatetime(), None, 1.0, 1.0, 1.0, 5))   # dropped before indicators (P4)
    df = spark.createDataFrame(rows, "ticker string, date timestamp_ntz, open double, high double, low double, "
                                     "close double, volume bigint")
    out = modular_features(df).toPandas()
    short = out[out.ticker == "SHORT"]
    assert len(short) == 30 and short[MODULAR_COLUMNS].isna().all().all()
    long = out[out.ticker == "LONG"].sort_values("date")
    assert len(long) == 120 - 49 and long[MODULAR_COLUMNS].notna().all().all()
    assert long["date"].min() == pd.Timestamp("2020-01-01") + pd.Timedelta(days=49)


def test_required_gate_and_symbols(spark):
    from barwright.operators.bars import required_gate
    root = tempfile.mkdtemp(prefix="bw-gate-")
    day = os.path.join(root, "dt=2025-01-16")
    os.makedirs(day)
    pd.DataFrame({"Date": ["2025-01-16"], "Open": [1.0], "High": [2.0], "Low": [0.5], "Close": [1.5],
                  "Volume": [10]}).to_csv(os.path.join(day, "GOOD.csv"), index=False)
    pd.DataFrame({"Date": ["2025-01-16"], "Open": [1.0], "High": [2.0], "Low": [0.5],
                  "Volume": [10]}).to_csv(os.path.join(day, "NOCLOSE.csv"), index=False)
    ok, skipped = required_gate(landed.read_landed(spark, root))
    assert {x.ticker for x in ok.collect()} == {"GOOD"}
    assert [(x.ticker, x.missing) for x in skipped.collect()] == [("NOCLOSE", ["close"])]
    sym = os.path.join(tempfile.mkdtemp(prefix="bw-sym-"), "tickers.csv")
    pd.DataFrame({"symbol": ["AAPL", "MSFT"], "company_name": ["Apple", "Microsoft"]}).to_csv(sym, index=False)
    assert [(x.symbol, x.company_name) for x in io.read_symbols(spark, sym).orderBy("pos").collect()] == [
        ("AAPL", "Apple"), ("MSFT", "Microsoft")]


def test_sinks_features_landed_events(spark):
    import datetime as dt
    base = tempfile.mkdtemp(prefix="bw-sinks-")
    bars = spark.createDataFrame([("AAPL", dt.datetime(2025, 1, 15), 1.0, 2.0, 0.5, 1.5, 10),
                                  ("MSFT", dt.datetime(2025, 1, 15), 3.0, 4.0, 2.5, 3.5, 20)],
                                 "ticker string, date timestamp_ntz, open double, high double, low double, "
                                 "close double, volume bigint")
    feats = os.path.join(base, "processed")
    io.write_features(bars, feats, "2025-01-15")
    io.write_features(bars.filter("ticker = 'AAPL'"), feats, "2025-01-16")
    io.write_features(bars.filter("ticker = 'MSFT'"), feats, "2025-01-16")   # replaces that date only
    got = {(str(x.dt), x.ticker) for x in spark.read.parquet(feats).collect()}
    assert got == {("2025-01-15", "AAPL"), ("2025-01-15", "MSFT"), ("2025-01-16", "MSFT")}
    raw = os.path.join(base, "raw")
    assert io.write_landed(bars, raw, "2025-01-15", dry_run=True) == 0 and not os.path.exists(raw)
    assert io.write_landed(bars, raw, "2025-01-15") == 1
    back = landed.read_landed(spark, raw)
    assert sorted((x.ticker, x.close, x.volume) for x in back.collect()) == [("AAPL", 1.5, 10), ("MSFT", 3.5, 20)]
    ev = os.path.join(base, "events")
    e = spark.createDataFrame([(dt.datetime(2025, 1, 15, 9), "fetch_start", "{}")],
                              "timestamp timestamp_ntz, event_type string, data string")
    io.append_events(e, ev)
    io.append_events(e, ev)
    assert spark.read.json(ev).count() == 2
