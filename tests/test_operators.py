"""Operator unit tests on literal fixtures (FIXTURES.md sections A and B)."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from barwright.functions.nulls import div, safe_divide
from barwright.operators import history as h
from barwright.operators import quality as qy
from barwright.operators import runs as r
from barwright.operators import universe as u
from barwright.operators.bars import missing_required, normalise_columns, ohlcv_bars
from barwright.sources import io
from barwright.sources.parse import html_constituents, parse_test_summary, vendor_series

BAR = "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume bigint"


def d(s):
    return dt.datetime.fromisoformat(s)


def test_clean_symbols(spark):
    raw = ["AAPL", "  GOOGL  ", "MSFT", "amzn", "IBM", "123", "A", "TOOLONG", "", "AAPL", "BRK.B"]
    df = spark.createDataFrame(list(enumerate(raw)), "pos int, symbol string")
    clean, rej = u.clean_symbols(df)
    got = [x.symbol for x in clean.orderBy("pos").collect()]
    assert got == ["AAPL", "GOOGL", "MSFT", "AMZN", "IBM", "123", "A"]
    reasons = {(x.raw, x.reason) for x in rej.collect()}
    assert ("TOOLONG", "invalid") in reasons and ("AAPL", "duplicate") in reasons and ("BRK.B", "invalid") in reasons
    share, _ = u.clean_symbols(df, share_class=True)
    assert "BRK.B" in {x.symbol for x in share.collect()}


def test_symbol_diff_and_counts(spark):
    cur = spark.createDataFrame([(s,) for s in ["AAPL", "GOOGL", "MSFT", "AMZN"]], "symbol string")
    prev = spark.createDataFrame([(s,) for s in ["AAPL", "GOOGL", "IBM", "ORCL"]], "symbol string")
    diff = u.symbol_diff(cur, prev)
    got = {(x.symbol, x.change) for x in diff.collect()}
    assert got == {("MSFT", "added"), ("AMZN", "added"), ("IBM", "removed"), ("ORCL", "removed")}
    c = u.diff_counts(diff).collect()[0]
    assert (c.tickers_added, c.tickers_removed, c.net_change) == (2, 2, 0)


def test_symbol_count_range(spark):
    five_hundred = spark.range(500).select(F.col("id").cast("string").alias("symbol"))
    assert u.symbol_count_check(five_hundred).collect()[0].count_ok is True
    assert u.symbol_count_check(five_hundred.limit(100)).collect()[0].count_ok is False


def test_company_lookup_on_cleaned_symbol(spark):
    syms = spark.createDataFrame([(" brk ",), ("MSFT",), ("ZZZ",)], "symbol string")
    names = spark.createDataFrame([("BRK", "Berkshire"), ("msft", "Microsoft")], "symbol string, company_name string")
    got = {x.symbol: x.company_name for x in u.company_lookup(syms, names).collect()}
    assert got == {" brk ": "Berkshire", "MSFT": "Microsoft", "ZZZ": None}


def test_upsert_keep_last(spark):
    hist = spark.createDataFrame([("A", d("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1),
                                  ("A", d("2024-01-02"), 2.0, 2.0, 2.0, 2.0, 1)], BAR)
    new = spark.createDataFrame([("A", d("2024-01-02"), 9.0, 9.0, 9.0, 9.0, 9),
                                 ("A", d("2024-01-03"), 3.0, 3.0, 3.0, 3.0, 1)], BAR)
    out = {x.date: x.close for x in h.upsert_keep_last([hist, new]).collect()}
    assert out == {d("2024-01-01"): 1.0, d("2024-01-02"): 9.0, d("2024-01-03"): 3.0}
    dup = spark.createDataFrame([("A", d("2024-01-05"), 1.0, 1.0, 1.0, 1.0, 1, 0),
                                 ("A", d("2024-01-05"), 5.0, 5.0, 5.0, 5.0, 1, 1)], BAR + ", seq int")
    out2 = h.upsert_keep_last([dup], seq="seq").collect()
    assert len(out2) == 1 and out2[0].close == 5.0


def test_watermark_filter_strict(spark):
    hist = spark.createDataFrame([("A", d("2024-01-10"), 1.0, 1.0, 1.0, 1.0, 1)], BAR)
    new = spark.createDataFrame([("A", d("2024-01-09"), 1.0, 1.0, 1.0, 1.0, 1),
                                 ("A", d("2024-01-10"), 1.0, 1.0, 1.0, 1.0, 1),
                                 ("A", d("2024-01-11"), 1.0, 1.0, 1.0, 1.0, 1),
                                 ("B", d("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1)], BAR)
    kept = {(x.ticker, x.date) for x in h.newer_than_watermark(new, h.watermark(hist)).collect()}
    assert kept == {("A", d("2024-01-11")), ("B", d("2024-01-01"))}


def test_ingest_plan_actions(spark):
    hist = spark.createDataFrame([("A", d("2024-01-10"), 1.0, 1.0, 1.0, 1.0, 1),
                                  ("B", d("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1)], BAR)
    uni = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    got = {x.ticker: (x.action, x.days_to_request) for x in h.ingest_plan(uni, hist, "2024-01-11 12:00:00").collect()}
    assert got == {"A": ("up_to_date", 0), "B": ("incremental", 15), "C": ("full", 30)}


def test_completeness_and_gaps(spark):
    rows = [("A", d("2024-01-01") + dt.timedelta(days=k), 1.0, 1.0, 1.0, 1.0, 1) for k in (0, 1, 2, 5, 6)]
    hist = spark.createDataFrame(rows, BAR)
    uni = spark.createDataFrame([("A",), ("Z",)], "ticker string")
    comp = {x.ticker: (x.rows, x.complete, x.missing_days) for x in h.completeness(hist, uni, 730).collect()}
    assert comp == {"A": (5, False, 725), "Z": (0, False, 730)}
    gaps = h.series_gaps(hist).collect()
    assert [(x.gap_start, x.gap_end, x.missing_days) for x in gaps] == [(d("2024-01-03"), d("2024-01-06"), 2)]
    gc = h.gap_check(hist, "2024-01-09 00:00:00").collect()[0]
    assert gc.days_behind == 2 and gc.needs_run


def test_ohlcv_bars_ties(spark):
    ticks = spark.createDataFrame([("A", d("2024-01-01 09:00:00"), 2, 10.0), ("A", d("2024-01-01 09:00:00"), 1, 11.0),
                                   ("A", d("2024-01-01 15:00:00"), 3, 9.0)], "t string, ts timestamp_ntz, id int, p double")
    b = ohlcv_bars(ticks, "t", "ts", "p", None, "day", "id").collect()[0]
    assert (b.open, b.high, b.low, b.close, b.volume) == (11.0, 11.0, 9.0, 9.0, 3)


def test_division_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (6.0, 3.0)], "a double, b double")
    got = [tuple(x) for x in df.select(div("a", "b"), safe_divide("a", "b", 0.0)).collect()]
    assert got[0][0] == float("inf") and got[1][0] == float("-inf") and got[2][0] is None
    assert got[3] == (None, None) and got[4] == (2.0, 2.0) and got[0][1] == 0.0


def test_normalise_and_required(spark):
    df = spark.createDataFrame([("2025-01-15", 100.0, 110.0, 90.0, float("nan"), 1000)],
                               "Date string, `1. open` double, HIGH double, low double, `4. close` double, volume bigint")
    n = normalise_columns(df)
    assert n.columns == ["date", "open", "high", "low", "close", "volume"]
    row = n.collect()[0]
    assert row.close is None and row.date == d("2025-01-15")
    assert missing_required(["date", "open", "close"]) == ["high", "low", "volume"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 3.0), (3, "c", float("nan"))],
                               "k int, s string, x double")
    prof = {x.column: x.missing for x in qy.null_profile(df).collect()}
    assert prof == {"k": 0, "s": 1, "x": 3}
    pct = qy.null_pct(df).collect()[0]
    assert pct.missing_cells == 4 and abs(pct.missing_pct - 100 * 4 / 12) < 1e-12
    assert qy.duplicate_rows(df).collect()[0].duplicate_rows == 1
    num = {x.column: (x.min, x.max) for x in qy.numeric_profile(df).collect()}
    assert num["k"] == (1.0, 3.0) and num["x"] == (3.0, 3.0)
    checks = {x.check: x.ok for x in qy.validate_frame(df, ["k", "s", "missing"], 5).collect()}
    assert checks == {"required_columns": False, "min_rows": False, "nulls:k": True, "nulls:s": False}
    assert qy.sample_fixed(df, 10, ["k", "s"]).count() == 4
    a = [tuple(x) for x in qy.sample_fixed(spark.range(1000), 5, ["id"]).collect()]
    b = [tuple(x) for x in qy.sample_fixed(spark.range(1000).repartition(7), 5, ["id"]).collect()]
    assert a == b


def test_rules_max_severity_vs_last(spark):
    facts = spark.createDataFrame([(1, 0.0, 400.0)], "id int, tests_failed double, runtime double")
    rules = [("tests", F.col("tests_failed") >= 0, "critical", "fix tests"),
             ("slow", F.col("runtime") > 300, "warning", "slow")]
    assert qy.evaluate_rules(facts, rules).collect()[0].status == "critical"
    assert qy.evaluate_rules(facts, rules, last_rule_wins=True).collect()[0].status == "warning"


def test_run_operators(spark):
    runs = spark.createDataFrame([
        ("r1", d("2024-01-01 00:00:00"), d("2024-01-01 00:10:00"), "daily", "completed", 0, None),
        ("r2", d("2024-01-02 00:00:00"), d("2024-01-02 00:01:00"), "daily", "failed", 1, "Fetch failed. timeout; x"),
        ("r3", d("2024-01-03 00:00:00"), None, "weekly", "running", 0, None),
        ("r4", d("2024-01-03 00:00:00"), d("2024-01-03 00:00:30"), "test", "failed", 5, "Fetch failed; y")],
        "run_id string, start_time timestamp_ntz, end_time timestamp_ntz, mode string, status string, "
        "retry_count int, error_message string")
    s = r.run_stats(runs).collect()[0]
    assert (s.total_runs, s.successful_runs, s.failed_runs, s.retried_runs) == (4, 1, 2, 2)
    assert abs(s.average_runtime_seconds - (600 + 60 + 30) / 3) < 1e-9
    modes = {x.mode: (x.total, x.successful, x.failed) for x in r.runs_by_mode(runs).collect()}
    assert modes["daily"] == (2, 1, 1) and modes["weekly"] == (1, 0, 1)
    assert {x.error_key: x.n for x in r.error_distribution(runs).collect()} == {"Fetch failed": 2}
    assert [x.run_id for x in r.retry_candidates(runs).collect()] == ["r2"]
    assert [x.run_id for x in r.stuck_runs(runs, "2024-01-03 03:00:00").collect()] == ["r3"]
    fm = runs.select(r.format_time(F.lit(59.94)).alias("a"), r.format_time(F.lit(90)).alias("b"),
                     r.format_time(F.lit(7200)).alias("c"),
                     r.format_progress(F.lit(0), F.lit(0), F.lit(1.0)).alias("p")).first()
    assert (fm.a, fm.b, fm.c, fm.p) == ("59.9s", "1.5m", "2.0h", "0/0 (0%)")


def test_vendor_json_and_errors(spark):
    good = json.dumps({"Time Series (Daily)": {"2025-01-16": {"1. open": "105", "2. high": "115", "3. low": "95",
                                                              "4. close": "110", "5. volume": "1200000"},
                                               "2025-01-15": {"1. open": "100", "2. high": "110", "3. low": "90",
                                                              "4. close": "105", "5. volume": "1000000"}}})
    bad = json.dumps({"Note": "rate limit"})
    df = spark.createDataFrame([("AAPL", good), ("MSFT", bad)], "ticker string, payload string")
    bars, errs = vendor_series(df, days=1)
    b = bars.collect()
    assert len(b) == 1 and b[0].date == d("2025-01-16") and b[0].close == 110.0 and b[0].volume == 1200000
    assert [(x.ticker, x.error) for x in errs.collect()] == [("MSFT", "rate limit")]


def test_html_constituents(spark):
    page = ('<table class="wikitable sortable"><tr><th>Symbol</th><th>Security</th></tr>'
            '<tr><td><a href="x">MMM</a></td><td>3M</td></tr><tr><td>AOS</td><td>A. O. Smith</td></tr>'
            '<tr><td></td><td>Empty</td></tr></table>')
    header_only = '<table class="wikitable"><tr><td>AAPL</td><td>Apple</td></tr></table>'
    df = spark.createDataFrame([("u1", page), ("u2", header_only), ("u3", "<ul><li>x</li></ul>")], "url string, html string")
    got = [(x.url, x.symbol, x.company) for x in html_constituents(df).orderBy("url", "pos").collect()]
    assert got == [("u1", "MMM", "3M"), ("u1", "AOS", "A. O. Smith")]


def test_parse_test_summary(spark):
    logs = spark.createDataFrame([(1, "FAILED tests/a.py::t1 - x\n3 failed, 10 passed, 2 skipped in 5s"),
                                  (2, "12 passed in 3s")], "k int, value string")
    last = parse_test_summary(logs, order="k").collect()[0]
    assert (last.passed, last.failed, last.skipped, last.failed_tests) == (12, 0, 0, [])
    first = parse_test_summary(logs.filter("k = 1")).collect()[0]
    assert (first.passed, first.failed, first.skipped, first.failed_tests) == (10, 3, 2, ["tests/a.py::t1"])


def test_partitions_and_retention(spark):
    root = tempfile.mkdtemp(prefix="bw-parts-")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "x int, dt date")
    io.write_partitioned(df, root, ["dt"])
    os.makedirs(os.path.join(root, "dt=not-a-date"))
    open(os.path.join(root, "dt=not-a-date", "f.txt"), "w").write("x")
    files = io.partitions(spark, root, "dt")
    assert sorted({x.dt for x in files.collect()}) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    cut = F.date_sub(F.lit("2024-03-02").cast("date"), 30)
    expired = [x.dt for x in files.select("dt").distinct().filter(F.col("dt") < cut).collect()]
    assert expired == [dt.date(2024, 1, 1)]
    assert io.idempotent_write(df.drop("dt"), root, "2024-01-01") == "skipped"
    assert io.delete_paths(spark, [f"{root}/dt=2024-01-01"]) == 1
    assert io.partition_exists(spark, root, "dt", "2024-01-01") is False


def test_format_roundtrip_small(spark):
    base = tempfile.mkdtemp(prefix="bw-fmt-")
    df = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "A bigint, B bigint")
    for fmt in ("parquet", "csv", "json"):
        io.save(df, os.path.join(base, fmt), fmt)
        back = io.load(spark, os.path.join(base, fmt), fmt, df.schema)
        assert sorted(map(tuple, back.collect())) == [(1, 4), (2, 5), (3, 6)]
    with pytest.raises(ValueError):
        io.save(df, os.path.join(base, "x"), "xml")
