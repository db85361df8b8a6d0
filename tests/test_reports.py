"""Report and maintenance operators on literal fixtures."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from barwright.operators import reports as rp
from barwright.session import release


def d(s):
    return dt.datetime.fromisoformat(s)


def test_availability_expected_vs_literal(spark):
    t = spark.createDataFrame([("raw", True), ("processed", False), ("tickers", False)], "table string, present boolean")
    ours = rp.availability(t).collect()[0]
    lit = rp.availability(t, literal=True).collect()[0]
    assert abs(ours.missing_data_pct - 200 / 3) < 1e-9 and lit.missing_data_pct == 200.0
    none = spark.createDataFrame([("raw", False)], "table string, present boolean")
    assert rp.availability(none, literal=True).collect()[0].missing_data_pct == 0.0


def test_run_state_and_flags(spark):
    ev = spark.createDataFrame([("r1", "running", d("2024-01-01 00:00:00")), ("r1", "completed", d("2024-01-01 01:00:00")),
                                ("r2", "running", d("2024-01-01 02:00:00"))], "run_id string, status string, timestamp timestamp_ntz")
    st = {x.run_id: (x.status, x.events) for x in rp.run_state(ev).collect()}
    assert st == {"r1": ("completed", 2), "r2": ("running", 1)}
    runs = spark.createDataFrame([("a", "daily"), ("b", "test")], "run_id string, mode string")
    fl = {x.run_id: (x.triggered_by, x.is_test, x.environment) for x in rp.run_flags(runs).collect()}
    assert fl == {"a": ("cron", False, "production"), "b": ("manual", True, "test")}


def test_report_retention_by_name(spark):
    files = spark.createDataFrame([("reports/daily/2024-01-01.json",), ("reports/weekly/2024-03-01.json",),
                                   ("2020-01-01/daily/notes.txt",)], "path string")
    got = {x.path: x.expired for x in rp.report_retention(files, "2024-03-02", 30).collect()}
    assert got == {"reports/daily/2024-01-01.json": True, "reports/weekly/2024-03-01.json": False,
                   "2020-01-01/daily/notes.txt": False}


def test_failed_tickers_and_throttle(spark):
    errs = spark.createDataFrame([("AAPL", "timeout")], "ticker string, error string")
    meta = spark.createDataFrame([(["AAPL", "ERROR"],)], "failed_tickers array<string>")
    got = {x.ticker: x.sources for x in rp.failed_tickers(errs, meta).collect()}
    assert got == {"AAPL": ["error_log", "metadata"], "ERROR": ["metadata"]}
    m = spark.createDataFrame([(3, 400.0), (0, 10.0)], "rate_limit_hits int, total_sleep_time double")
    assert [(x.rate_limited, x.slow_api) for x in rp.throttling_check(m).collect()] == [(True, True), (False, False)]


def test_timezones(spark):
    df = spark.createDataFrame([("2024-03-10T01:30:00-05:00",), ("2024-03-10T03:30:00Z",)], "s string")
    got = [(x.w, x.u) for x in df.select(rp.strip_zone(F.col("s")).alias("w"), rp.to_utc(F.col("s")).alias("u")).collect()]
    assert got == [(d("2024-03-10 01:30:00"), d("2024-03-10 06:30:00")), (d("2024-03-10 03:30:00"), d("2024-03-10 03:30:00"))]


def test_store_copy_and_first_tickers(spark):
    base = tempfile.mkdtemp(prefix="bw-store-")
    bars = spark.createDataFrame([("B", d("2024-01-02"), 1.0), ("A", d("2024-01-01"), 2.0), ("C", d("2024-01-03"), 3.0)],
                                 "ticker string, date timestamp_ntz, close double")
    meta = rp.store_data(bars, os.path.join(base, "s")).collect()[0]
    assert meta.ticker_count == 3 and meta.tickers == ["A", "B", "C"] and meta.start_date == d("2024-01-01")
    chk = rp.copy_table(spark, os.path.join(base, "s", "parquet"), os.path.join(base, "copy")).collect()[0]
    assert chk.ok and chk.rows_source == 3
    assert sorted(x.ticker for x in rp.first_tickers(bars, 2).collect()) == ["A", "B"]
    assert [x.ticker for x in rp.dropped_tickers(bars, bars.filter("ticker <> 'C'")).collect()] == ["C"]
    release()


def test_dashboard_document(spark):
    runs = spark.createDataFrame([(str(k), d("2024-01-01 00:00:00") + dt.timedelta(hours=k),
                                   d("2024-01-01 00:30:00") + dt.timedelta(hours=k),
                                   "daily", "failed" if k % 2 else "completed", 0,
                                   "stage fetch failed; x" if k % 2 else None) for k in range(12)],
                                 "run_id string, start_time timestamp_ntz, end_time timestamp_ntz, mode string, "
                                 "status string, retry_count int, error_message string")
    recs = rp.dashboard_recommendations(runs, "stage fetch failed", "stage features failed")
    got = {x.recommendation for x in recs.collect()}
    assert got == {"Low success rate detected - investigate recent failures",
                   "Multiple fetch_data failures - check API connectivity"}
    doc = rp.dashboard_document(runs, recs).collect()[0].document
    import json
    j = json.loads(doc)
    assert set(j) == {"summary", "recent_runs", "recommendations"} and len(j["recent_runs"]) == 10


def test_durations_ignore_session_zone(spark):
    from barwright.functions.time import instant_to_wall, seconds_between, wall_to_instant
    df = spark.createDataFrame([(d("2024-03-10 01:30:00"), d("2024-03-10 03:30:00"))], "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(seconds_between(F.col("b"), F.col("a")).alias("s"),
                        instant_to_wall(wall_to_instant(F.col("b"))).alias("w")).collect()[0]
        assert row.s == 7200.0 and row.w == d("2024-03-10 03:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_integrity_rules_texts(spark):
    facts = spark.createDataFrame([(1, False, 61.25, 7.0, 3, 12.0), (2, True, 10.0, 1.0, 0, 0.0)],
                                  "id int, processed_exists boolean, missing_pct double, runtime_minutes double, "
                                  "failed_tests int, null_pct double")
    got = {x.id: (x.status, x.recommendations) for x in rp.integrity_rules(facts).collect()}
    assert got[1] == ("critical", ["No processed data found - pipeline may have failed",
                                   "High missing data percentage: 61.3%", "Pipeline runtime exceeded threshold",
                                   "3 tests failed - investigate immediately", "High null percentage in processed data"])
    assert got[2] == ("healthy", [])
    literal = {x.id: x.status for x in rp.integrity_rules(facts, last_rule_wins=True).collect()}
    assert literal[1] == "warning"


def test_format_progress(spark):
    from barwright.operators import runs as r
    df = spark.createDataFrame([(0, 10, 5.0), (5, 10, 30.0), (0, 0, 1.0), (1, 3, 4000.0)], "c int, t int, e double")
    got = [x.p for x in df.select(r.format_progress(F.col("c"), F.col("t"), F.col("e")).alias("p")).collect()]
    assert got == ["0/10 (0.0%)", "5/10 (50.0%) ETA: 30.0s", "0/0 (0%)", "1/3 (33.3%) ETA: 2.2h"]
