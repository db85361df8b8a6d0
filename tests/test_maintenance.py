"""Run log, logs and reports as files, retention, outcomes, duplicates, bars of any volume."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barwright.operators import bars as b
from barwright.operators import history as h
from barwright.operators import quality as qy
from barwright.operators import runlog as rl
from barwright.operators import runs as r
from barwright.plans import q_maintenance
from barwright.sources import io, parse

D = dt.datetime


def test_volume_keeps_fractions(spark):
    ticks = [("A", D(2024, 1, 1, i), 1.0 + i, v) for i, v in enumerate((0.4, 0.4, float("nan"), None))]
    t = spark.createDataFrame(ticks, "t string, ts timestamp_ntz, p double, v double")
    assert abs(b.ohlcv_bars(t, "t", "ts", "p", "v").first().volume - 0.8) < 1e-12
    assert b.ohlcv_bars(t.where("v IS NULL"), "t", "ts", "p", "v").first().volume is None
    for kind, want in (("int", "bigint"), ("decimal(10,2)", "double"), ("float", "double")):
        df = b.ohlcv_bars(t.where("NOT isnan(v)").withColumn("v", F.col("v").cast(kind)), "t", "ts", "p", "v")
        assert dict(df.dtypes)["volume"] == want
    assert b.ohlcv_bars(t, "t", "ts", "p").first().volume == 4


def test_days_of_every_payload(spark):
    pay = lambda *days: json.dumps({"Time Series (Daily)": {d: {"4. close": str(i)} for i, d in enumerate(days)}})
    df = spark.createDataFrame([("A", pay("2025-01-03", "2025-01-01", "2025-01-02")), ("A", pay("2024-01-01")), ("B", "{}"), ("C", None),
                                ("D", '{"Error Message": "bad"}')], "ticker string, payload string")
    bars, errors = parse.vendor_series(df, days=1)
    assert sorted((x.ticker, str(x.date)[:10]) for x in bars.collect()) == [("A", "2024-01-01"), ("A", "2025-01-03")]
    assert sorted((x.ticker, x.error) for x in errors.collect()) == [("B", "no series"), ("C", "no series"), ("D", "bad")]
    assert parse.vendor_series(df, days=5)[0].count() == 4


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicates(spark, monkeypatch, limit):
    monkeypatch.setattr(qy, "BROADCAST_DIGESTS", limit)
    rows = [("x" * 5000, 1.0), ("x" * 5000, 1.0), ("x" * 5000, None), (None, None), (None, None), (None, None), ("y", 2.0)]
    df = spark.createDataFrame(rows, "a string, b double")
    assert tuple(qy.duplicate_rows(df).first()) == (3, 4)
    assert tuple(qy.duplicate_rows(df.limit(0)).first()) == (0, 0)
    assert tuple(qy.duplicate_rows(df.where("a = 'y'")).first()) == (0, 1)


def test_ingest_outputs(spark):
    bar = "ticker string, date timestamp_ntz, close double"
    day = lambda i: D(2024, 1, 1) + dt.timedelta(days=i)
    hist = spark.createDataFrame([("A", day(i), float(i)) for i in range(40)] + [("OLD", day(0), 1.0)], bar)
    new = spark.createDataFrame([("A", day(39), -1.0, 0), ("A", day(40), 1.0, 1), ("A", day(40), 2.0, 2), ("N", day(3), 5.0, 3)], bar + ", _seq int")
    universe = spark.createDataFrame([("A",), ("N",), ("GONE",)], "ticker string")
    got = h.ingest_apply(hist, new, universe)
    out = {(x.ticker, x.date): x.close for x in got.output.collect()}
    assert len(out) == 31 and out["A", day(40)] == 2.0 and out["A", day(39)] == 39.0 and out["N", day(3)] == 5.0 and ("A", day(10)) not in out
    assert got.history.count() == 43  # OLD stays in the history, outside the universe
    assert {x.ticker: (x.rows_before, x.rows_added, x.status) for x in got.outcome.collect()} == {
        "A": (40, 2, "updated"), "N": (0, 1, "updated"), "GONE": (0, 0, "failed")}


def test_stage_outcome(spark):
    row = lambda t, c: (t, D(2024, 1, 1), 1.0, 1.0, 1.0, c, 1.0)
    bars = spark.createDataFrame([row("A", 1.0), row("A", None), row(None, 1.0), row("B", None)],
                                 "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume double")
    outcome, failures, summary = h.stage_outcome(bars, spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string"))
    assert {x.ticker: (x.rows, x.rows_dropped, x.ok) for x in outcome.collect()} == {"A": (1, 1, True), "B": (0, 1, True), "C": (0, 0, False)}
    assert [tuple(x) for x in failures.collect()] == [("C", "no data")]
    s = summary.first()
    assert (s.rows_dropped, s.total_rows, s.status, s.error_message) == (3, 1, "partial_success", "Failed to process 1 tickers")
    assert h.stage_outcome(bars, spark.createDataFrame([("A",)], "ticker string"))[2].first().error_message is None


def test_sessions_in_logs(spark):
    block = lambda body: f"start 99 passed\n=== build in 2s ===\n7 passed\n==== test session starts in 5s ====\n{body}\n==== 8 failed in 1s ====\n"
    logs = spark.createDataFrame([
        (1, block("tests/a.py::one\ntests/b.py::two[x] - E\n10 passed, 3 failed, 2 skipped") + block("44 passed"), D(2024, 1, 1)),
        (2, "no session, 5 passed", D(2024, 1, 2)), (3, block("12 passed"), D(2024, 1, 3)), (4, None, D(2024, 1, 4))],
        "order int, value string, modified timestamp_ntz")
    x = parse.test_results(logs).first()
    # counts that the third log does not name are those of the first one
    assert (x.passed, x.failed, x.skipped, x.total_tests, x.failed_tests, x.last_run) == (12, 3, 2, 17, [], D(2024, 1, 3))
    x = parse.test_results(logs.where("order = 1")).first()
    assert (x.passed, x.failed, x.failed_tests) == (10, 3, ["one", "two[x]"])
    x = parse.test_results(logs.where("order = 2")).first()
    assert (x.passed, x.total_tests, x.failed_tests, x.last_run) == (0, 0, [], None)


def test_logs_share_files(spark, tmp_path, monkeypatch):
    texts = [("1", "a\n\nrun 9\nb\n"), ("2", ""), (None, "c\r\nd"), ("3", None)]
    parse.write_logs(spark.createDataFrame(texts, "run string, value string").coalesce(1), f"{tmp_path}/logs")
    got = parse.read_logs(spark, f"{tmp_path}/logs").collect()
    assert sorted((x.order, x.value) for x in got) == [("", "c\r\nd"), ("1", texts[0][1]), ("2", ""), ("3", "")]
    with pytest.raises(Exception, match="end mark"):
        parse.write_logs(spark.createDataFrame([("1", "a\x1eb")], "run string, value string"), f"{tmp_path}/bad")
    # the files of the query do not grow with the suppliers
    spark.range(200).selectExpr("id + 1 AS l_suppkey", "if(id % 2 = 0, 'R', 'N') AS l_returnflag").write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(q_maintenance, "scratch_dir", lambda s, name: f"{tmp_path}/{name}")
    x = q_maintenance.test_results_q(spark, f"{tmp_path}/sf").first()
    assert (x.passed, x.failed, x.skipped, x.total_tests, x.failed_tests) == (1, 0, 0, 1, "test_a200,test_b[x]")
    files = [f for _, _, names in os.walk(f"{tmp_path}/test-logs") for f in names if f.endswith(".txt")]
    assert 1 <= len(files) <= 16


def test_old_logs_are_not_read(spark, tmp_path):
    for name, hours in (("new.log", 1), ("old.log", 25), ("new.txt", 1)):
        (tmp_path / name).write_text("Error error\nfine\n")
        at = D(2024, 3, 1, 12, tzinfo=dt.UTC).timestamp() - 3600 * hours
        os.utime(tmp_path / name, (at, at))
    got = parse.recent_errors(spark, str(tmp_path), "2024-03-01T12:00:00")
    assert [(os.path.basename(x.path), x.errors) for x in got.collect()] == [("new.log", 2)]
    assert parse.log_files(spark, str(tmp_path), "2024-03-01T12:00:00").inputFiles()[0].endswith("new.log")


def test_retention_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    for d in ("2024-01-01", "2024-01-02", "2024-03-01", "odd"):
        for tree in ("data", "logs"):
            os.makedirs(tmp_path / tree / f"dt={d}")
    roots = {t: f"{tmp_path}/{t}" for t in ("data", "logs", "none")}
    assert io.retention_apply(spark, roots, f"{tmp_path}/out", "2024-03-10", 30, dry_run=True)["total_deleted"] == 4
    real, calls = io.fs.delete, []

    def flaky(s, path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("lost")
        return real(s, path)
    monkeypatch.setattr(io.fs, "delete", flaky)
    with pytest.raises(OSError):
        io.retention_apply(spark, roots, f"{tmp_path}/out", "2024-03-10", 30)
    monkeypatch.setattr(io.fs, "delete", real)
    log = io.retention_apply(spark, roots, f"{tmp_path}/out", "2024-03-10", 30)
    assert log["total_deleted"] == 2 and sorted(os.listdir(tmp_path / "data")) == sorted(os.listdir(tmp_path / "logs")) == ["dt=2024-03-01", "dt=odd"]
    assert io.retention_apply(spark, roots, f"{tmp_path}/out", "2024-03-10", 30)["total_deleted"] == 0
    assert json.loads((tmp_path / "out/cleanup_2024-03-10.json").read_text())["total_deleted"] == 0


def test_run_log_is_folded(spark, tmp_path):
    root = f"{tmp_path}/log"
    at = lambda s: F.lit(f"2024-01-01 00:00:{s:02d}").cast("timestamp_ntz")
    one = spark.range(1)
    ev = lambda kind, run, s, **f: rl.append(one.select(*rl.event(kind, F.lit(run), at(s), **{k: F.lit(v) for k, v in f.items()})), root)
    ev("end", "a", 9, exit_code=1, error_message="fetch failed. x")  # events may come in any order
    ev("checkpoint", "a", 5, stage="fetch", tickers_processed=3, total_tickers=4, elapsed_seconds=6.0)
    ev("checkpoint", "a", 4, stage="fetch", tickers_processed=1, total_tickers=4, elapsed_seconds=5.0)
    ev("start", "a", 1, mode="daily", is_test=False, retry_count=2)
    ev("start", "a", 1, mode="daily", is_test=False, retry_count=2)  # and twice
    ev("start", "b", 2, mode="weekly", is_test=True)
    ev("checkpoint", "lost", 3, stage="x", tickers_processed=0, total_tickers=0, elapsed_seconds=1.0)
    events = rl.read(spark, root)
    got = {x.run_id: x for x in rl.states(events).collect()}
    a = got["a"]
    assert (a.status, a.exit_code, a.mode, a.retry_count, a.checkpoints, a.current_stage, a.progress_percent, a.estimated_remaining) == (
        "failed", 1, "daily", 2, 2, "fetch", 75.0, 2.0)
    assert (got["b"].status, got["b"].checkpoints, got["b"].current_stage, got["b"].end_time) == ("running", 0, None, None)
    assert got["lost"].start_time is None and got["lost"].progress_percent == 0.0
    last = rl.last_runs(events, 5)
    assert [f.name for f in last.schema] == [f.name for f in r.RUN_LOG]
    docs = {x.run_id: x for x in last.collect()}
    assert set(docs) == {"a", "b"} and [c.tickers_processed for c in docs["a"].checkpoints] == [1, 3] and docs["b"].checkpoints is None
    io.write_json_doc(last, f"{tmp_path}/doc")
    back = io.read_json_doc(spark, f"{tmp_path}/doc", r.RUN_LOG)
    assert r.run_stats(r.runs_from_log(back)).first().total_runs == 2 and r.stage_rollup(back).count() == 2
    assert rl.read(spark, root, since="2024-01-02").count() == 0
    text = spark._jvm.PythonSQLUtils.explainString(rl.read(spark, root, since="2024-01-02")._jdf.queryExecution(), "formatted")
    assert "dt#" in text.split("PartitionFilters: ")[1].splitlines()[0]


def test_newest_reports(spark, tmp_path):
    for kind in ("daily", "summary"):
        os.makedirs(tmp_path / kind)
        for i in range(1, 8):
            (tmp_path / kind / f"2024-01-0{i}.json").write_text(json.dumps({"n": i}, indent=1))
    got = {x.key: json.loads(x.document)["n"] for x in io.read_reports(spark, str(tmp_path), {"daily": 2, "summary": 1}).collect()}
    assert got == {"daily_2024-01-06": 6, "daily_2024-01-07": 7, "summary_2024-01-07": 7}
    assert io.read_reports(spark, str(tmp_path), {"weekly": 2}).count() == 0
