"""Reports and table-maintenance helpers built on the other operators: availability and
missing-data percentage (Q3, A18), feature-table profile (Q2), run-log and dashboard rules
(Q5-Q7), the dashboard document (Q8), run state from events (M9, M10), run-log and report
retention (M7, M8), failed tickers (M15), throttling check (M16), table copy (M14),
combined store with metadata (K6), time-zone edges (P9, P10), test-mode ticker limit (P11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.operators import quality as qy
from barwright.operators import runs as r

# Fixed values of the report rules: thresholds and recommendation texts.
REC_FAILED_RUNS = "Investigate failed runs and consider retry mechanism"
REC_RETRIED_RUNS = "Monitor retry patterns to identify recurring issues"
REC_SLOW_RUNS = "Consider optimizing pipeline performance"
REC_LOW_SUCCESS = "Low success rate detected - investigate recent failures"
REC_FETCH_FAILURES = "Multiple fetch_data failures - check API connectivity"
REC_FEATURE_FAILURES = "Feature processing issues detected - review data quality"
REC_NO_PROCESSED = "No processed data found - pipeline may have failed"
REC_HIGH_MISSING = "High missing data percentage: {pct}%"
REC_TESTS_FAILED = "{n} tests failed - investigate immediately"
REC_HIGH_NULLS = "High null percentage in processed data"
REC_FAILED_TESTS = "Investigate failed tests"
REC_PIPELINE_SLOW = "Pipeline runtime exceeded threshold"
LOW_SUCCESS_PCT = 80
FETCH_FAILURES_MAX = 2
FEATURE_FAILURES_MAX = 1
PIPELINE_SLOW_SECONDS = 300
THROTTLE_SLEEP_SECONDS = 300
BASE_FEATURE_COLUMNS = 7   # ticker, date, open, high, low, close, volume


def features_generated(df: DataFrame) -> int:
    """Indicator columns of a feature table: all columns minus the 7 base ones (A10)."""
    return len(df.columns) - BASE_FEATURE_COLUMNS


def availability(tables: DataFrame, literal: bool = False) -> DataFrame:
    """Missing-data percentage over expected tables.

    ``tables``: (table, present boolean).  Ours divides missing by expected tables; the
    literal form divides by present tables and reports 0 when none is present."""
    missing = F.count_if(~F.col("present"))
    present = F.count_if(F.col("present"))
    denom = present if literal else F.count(F.lit(1))
    pct = F.when(denom > 0, missing * 100.0 / denom).otherwise(F.lit(0.0))
    return tables.agg(F.count(F.lit(1)).cast("long").alias("expected"), present.cast("long").alias("present"),
                      missing.cast("long").alias("missing"), pct.alias("missing_data_pct"))


def table_quality(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Availability and quality of one table (Q3): rows, tickers, null %, duplicate rows."""
    base = df.agg(F.count(F.lit(1)).cast("long").alias("rows"),
                  F.count_distinct(F.col(key)).cast("long").alias("tickers"))
    nul = qy.null_pct(df).select("missing_pct")
    dup = qy.duplicate_rows(df).select("duplicate_rows")
    # three one-row aggregates side by side: tag and fold into one row without a join
    parts = (base.select(F.lit(0).alias("_k"), "rows", "tickers", F.lit(None).cast("double").alias("null_pct"),
                         F.lit(None).cast("long").alias("duplicate_rows"))
             .unionByName(nul.select(F.lit(0).alias("_k"), F.lit(None).cast("long").alias("rows"),
                                     F.lit(None).cast("long").alias("tickers"), F.col("missing_pct").alias("null_pct"),
                                     F.lit(None).cast("long").alias("duplicate_rows")))
             .unionByName(dup.select(F.lit(0).alias("_k"), F.lit(None).cast("long").alias("rows"),
                                     F.lit(None).cast("long").alias("tickers"), F.lit(None).cast("double").alias("null_pct"),
                                     "duplicate_rows")))
    return parts.groupBy("_k").agg(*[F.max(c).alias(c) for c in ("rows", "tickers", "null_pct", "duplicate_rows")]) \
                .drop("_k")


def features_profile(df: DataFrame, expected: list[str], expected_tickers: int = 503,
                     sample: int = 5) -> dict[str, DataFrame]:
    """Profile of a feature table (Q2): shape and tickers vs expected, expected columns,
    missing values, numeric stats, a fixed sample.  One DataFrame per section."""
    shape = df.agg(F.count(F.lit(1)).cast("long").alias("rows"),
                   F.count_distinct("ticker").cast("long").alias("tickers")).withColumn(
        "columns", F.lit(len(df.columns)).cast("long")).withColumn(
        "tickers_ok", F.col("tickers") == expected_tickers)
    return {"shape": shape, "expected_columns": qy.expected_columns(df, expected),
            "missing": qy.null_profile(df), "stats": qy.numeric_profile(df),
            "sample": qy.sample_fixed(df, sample, ["ticker", "date"])}


def run_rules(runs: DataFrame) -> DataFrame:
    """Run-log recommendations (Q5): any failed run, any retried run, mean runtime > 1 h."""
    stats = r.run_stats(runs)
    rules = [("failed_runs", F.col("failed_runs") > 0, "warning", REC_FAILED_RUNS),
             ("retried_runs", F.col("retried_runs") > 0, "warning", REC_RETRIED_RUNS),
             ("slow_runs", F.coalesce(F.col("average_runtime_seconds"), F.lit(0.0)) > r.SLOW_RUN_SECONDS, "warning",
              REC_SLOW_RUNS)]
    return qy.evaluate_rules(stats, rules)


def dashboard_recommendations(runs: DataFrame, fetch_key: str, feature_key: str,
                              report_recs: DataFrame | None = None) -> DataFrame:
    """Dashboard recommendations (Q6): success below 80 % over the last 10 runs, more than 2
    fetch failures, more than 1 feature failure, plus report recommendations; de-duplicated."""
    summary = r.dashboard_summary(runs, 10)
    # failures of the same ten runs as the summary
    errs = r.error_distribution(runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(10))
    e = errs.agg(F.coalesce(F.sum(F.when(F.col("error_key") == fetch_key, F.col("n"))), F.lit(0)).alias("fetch"),
                 F.coalesce(F.sum(F.when(F.col("error_key") == feature_key, F.col("n"))), F.lit(0)).alias("feat"))
    recs = (summary.select(F.when(F.col("success_rate") < LOW_SUCCESS_PCT,
                                  F.lit(REC_LOW_SUCCESS)).alias("rec"))
            .unionByName(e.select(F.when(F.col("fetch") > FETCH_FAILURES_MAX,
                                         F.lit(REC_FETCH_FAILURES)).alias("rec")))
            .unionByName(e.select(F.when(F.col("feat") > FEATURE_FAILURES_MAX,
                                         F.lit(REC_FEATURE_FAILURES)).alias("rec"))))
    if report_recs is not None:
        recs = recs.unionByName(report_recs.select(F.col("recommendation").alias("rec")))
    return recs.filter(F.col("rec").isNotNull()).distinct().withColumnRenamed("rec", "recommendation")


def one_decimal(x: Column) -> Column:
    """x with one decimal as text; rounded first (half away from zero) so no engine's
    formatter decides a tie."""
    return F.format_string("%.1f", F.round(x.cast("double") * 10.0, 0) / 10.0)


def integrity_rules(facts: DataFrame, max_runtime_minutes: float = 5, last_rule_wins: bool = False) -> DataFrame:
    """Integrity-report rules (Q4) on fact rows with columns ``processed_exists``,
    ``missing_pct``, ``runtime_minutes``, ``failed_tests``, ``null_pct``: no processed data
    -> critical, missing > 50 % -> warning, runtime above the limit -> warning, failed tests
    -> critical, nulls > 10 % -> warning.  Status = max severity (``last_rule_wins`` for the
    literal assignment order)."""
    pct_text = F.replace(F.lit(REC_HIGH_MISSING), F.lit("{pct}"), one_decimal(F.col("missing_pct")))
    tests_text = F.replace(F.lit(REC_TESTS_FAILED), F.lit("{n}"), F.col("failed_tests").cast("string"))
    rules = [("no_processed", ~F.col("processed_exists"), "critical", REC_NO_PROCESSED),
             ("missing", F.col("missing_pct") > 50, "warning", pct_text),
             ("runtime", F.col("runtime_minutes") > max_runtime_minutes, "warning", REC_PIPELINE_SLOW),
             ("tests", F.col("failed_tests") > 0, "critical", tests_text),
             ("nulls", F.col("null_pct") > 10, "warning", REC_HIGH_NULLS)]
    return qy.evaluate_rules(facts, rules, last_rule_wins)


def pipeline_report(test_failed: Column, total_seconds: Column) -> tuple[Column, Column]:
    """Pipeline report rules (Q7): (status, recommendations) from failed tests and total time.
    Both rules may fire; recommendations are joined with '; ' (NULL when none fires)."""
    status = (F.when(test_failed > 0, F.lit("critical"))
               .when(total_seconds > PIPELINE_SLOW_SECONDS, F.lit("warning")).otherwise(F.lit("healthy")))
    recs = F.concat_ws("; ", F.when(test_failed > 0, F.lit(REC_FAILED_TESTS)),
                       F.when(total_seconds > PIPELINE_SLOW_SECONDS, F.lit(REC_PIPELINE_SLOW)))
    return status, F.when(recs != "", recs)


def dashboard_document(runs: DataFrame, recs: DataFrame) -> DataFrame:
    """The dashboard as one JSON document (Q8): summary, last 10 runs, recommendations.
    Every part is bounded (one row, ten runs, a handful of rules)."""
    summary = r.dashboard_summary(runs, 10).select(F.to_json(F.struct("*")).alias("j"))
    last10 = runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(10)
    runs_j = last10.agg(F.to_json(F.array_sort(F.collect_list(F.struct("start_time", "run_id", "status", "mode")))).alias("j"))
    recs_j = recs.agg(F.to_json(F.array_sort(F.collect_list("recommendation"))).alias("j"))
    parts = (summary.select(F.lit("summary").alias("k"), "j").unionByName(runs_j.select(F.lit("recent_runs").alias("k"), "j"))
             .unionByName(recs_j.select(F.lit("recommendations").alias("k"), "j")))
    return parts.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(
        F.concat(F.lit('"'), F.col("k"), F.lit('":'), F.col("j")))), ","), F.lit("}")).alias("document"))


def run_state(events: DataFrame, run: str = "run_id", ts: str = "timestamp", tiebreak: str | None = None) -> DataFrame:
    """Current state of every run from appended run events (M9): the latest event per run
    wins (``max_by`` on the event time) - no in-place edit of a log file."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    cols = [c for c in events.columns if c != run]
    return events.groupBy(run).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("s"),
                                   F.count(F.lit(1)).cast("long").alias("events")).select(run, "s.*", "events")


# Fixed values of a run's metadata: version, directories and retention, of test and other runs.
PIPELINE_VERSION = "1.0.0"
DIRECTORIES = {"raw": ("data/test/raw", "data/raw"), "processed": ("data/test/processed", "data/processed"), "logs": ("logs/test", "logs")}
TEST_RETENTION = ("immediate", "30_days")
PRODUCTION_RETENTION = "90_days"


def run_metadata(runs: DataFrame) -> DataFrame:
    """Metadata document of every run (M10): its flags, pipeline version, data directories and
    retention policy."""
    choose = lambda pair: F.when(F.col("is_test"), F.lit(pair[0])).otherwise(F.lit(pair[1]))
    return run_flags(runs).withColumn("pipeline_version", F.lit(PIPELINE_VERSION)).withColumn(
        "data_directories", F.struct(*[choose(v).alias(k) for k, v in DIRECTORIES.items()])).withColumn(
        "retention_policy", F.struct(choose(TEST_RETENTION).alias("test_data"), F.lit(PRODUCTION_RETENTION).alias("production_data")))


def partition_status(spark, roots: dict[str, str], as_of: str) -> DataFrame:
    """Partitions of the named trees (Q9, A16): tree, exists, latest_partition, partition_count,
    days_old; from directory names."""
    from barwright.sources import fs
    rows = []
    for tree, root in roots.items():
        names = [n[3:] for n in fs.subdirectories(spark, root, "dt=")]
        rows.append((tree, fs.exists(spark, root), names))
    t = spark.createDataFrame(rows, "tree string, exists boolean, names array<string>")
    dates = F.array_sort(F.array_compact(F.transform("names", lambda n: F.try_to_date(n, "yyyy-MM-dd"))))
    last = F.try_element_at("dates", F.lit(-1))
    return t.withColumn("dates", dates).select("tree", "exists", last.cast("string").alias("latest_partition"),
                                               F.size("dates").cast("long").alias("partition_count"),
                                               F.datediff(F.lit(as_of).cast("date"), last).alias("days_old"))


def data_availability(spark, roots: dict[str, str], dt: str) -> DataFrame:
    """Files of one date in every tree (Q3): tree, exists, file_count, size_mb, missing_data_pct (trees
    without the date, of all); from listings, no file is read."""
    from barwright.sources import fs
    rows = []
    for tree, root in roots.items():
        at = f"{root}/dt={dt}"
        rows.append((tree, at, fs.exists(spark, at)))
    t = spark.createDataFrame(rows, "tree string, at string, exists boolean")
    paths = [at for _, at, there in rows if there]
    if paths:
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
                  .select("length", "path"))
        sizes = listed.join(F.broadcast(t.select("tree", "at")), F.col("path").contains(F.col("at"))).groupBy("tree").agg(  # a few trees
            F.count(F.lit(1)).alias("file_count"), (F.sum("length") / 1048576.0).alias("size_mb"))
    else:
        sizes = spark.createDataFrame([], "tree string, file_count long, size_mb double")
    share = availability(t.select(F.col("exists").alias("present"))).select("missing_data_pct")
    return t.join(sizes, "tree", "left").join(share).select(
        "tree", "exists", F.coalesce("file_count", F.lit(0)).cast("long").alias("file_count"), F.coalesce("size_mb", F.lit(0.0)).alias("size_mb"),
        F.col("missing_data_pct").cast("double").alias("missing_data_pct"))


#: metrics that a report takes from the metadata of the feature stage
METRICS = ("runtime_seconds", "runtime_minutes", "tickers_processed", "tickers_successful", "tickers_failed", "features_generated")


def pipeline_metrics(metadata: DataFrame) -> DataFrame:
    """Pipeline metrics of a report (Q3) from stage metadata documents: missing numbers are 0, a
    missing status is ``unknown``."""
    has = set(metadata.columns)
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in has else F.lit(0.0)
    status = F.coalesce(F.col("status"), F.lit("unknown")) if "status" in has else F.lit("unknown")
    return metadata.select(*[number(c).alias(c) for c in METRICS], status.alias("status"))


def status_documents(spark, runs: DataFrame, roots: dict[str, str], as_of: str, last: int = 10) -> DataFrame:
    """Status documents (Q9) as (document, json): ``pipeline`` (is a run going on, the newest run),
    ``data`` (partitions of every tree), ``runs`` (the newest ``last`` runs).  Every part is bounded:
    a few runs and one entry per tree."""
    fields = ("run_id", "start_time", "end_time", "mode", "status", "retry_count")
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c)
    run = F.struct(*[text(c) if c.endswith("_time") else F.col(c) for c in fields])
    newest = runs.orderBy(F.desc("start_time"), F.desc("run_id")).limit(last)
    # ascending, as a log has them
    listed = F.transform(F.array_sort(F.collect_list(F.struct("start_time", "run_id", run.alias("r")))), lambda x: x["r"])
    recent = newest.agg(listed.alias("runs"))
    going = runs.agg(F.coalesce(F.max(F.col("status") == "running"), F.lit(False)).alias("running"))
    pipeline = going.join(recent.select(F.try_element_at("runs", F.lit(-1)).alias("last_run")))
    data = partition_status(spark, roots, as_of).agg(F.array_sort(F.collect_list(F.struct(
        "tree", "exists", "latest_partition", "partition_count", "days_old"))).alias("trees"))
    doc = lambda name, df: df.select(F.lit(name).alias("document"), F.to_json(F.struct("*")).alias("json"))
    return doc("pipeline", pipeline).unionByName(doc("data", data)).unionByName(doc("runs", recent))


def run_flags(runs: DataFrame, environment: str = "production") -> DataFrame:
    """Run metadata flags (M10): environment ('test' for test runs), triggered_by (daily / weekly
    -> cron)."""
    trig = F.when(F.col("mode").isin("daily", "weekly"), F.lit("cron")).otherwise(F.lit("manual"))
    return runs.withColumn(
        "environment", F.when(F.col("mode") == "test", F.lit("test")).otherwise(F.lit(environment))).withColumn("triggered_by", trig) \
               .withColumn("is_test", F.col("mode") == "test")


def runlog_retention(runs: DataFrame, as_of, days: int) -> DataFrame:
    """Runs kept by the run-log retention (M8): started within ``days`` of ``as_of``."""
    return r.recent(runs, as_of, days)


def report_retention(files: DataFrame, as_of, days: int, path: str = "path") -> DataFrame:
    """Report files older than ``days`` (M7): the date is the whole stem of a
    ``daily|weekly|summary/<date>.json`` file; every other file is kept."""
    d = F.try_to_date(F.regexp_extract(F.col(path), r"(?:^|/)(?:daily|weekly|summary)/(\d{4}-\d{2}-\d{2})\.json$", 1),
                      "yyyy-MM-dd")
    cut = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return files.withColumn("file_date", d).withColumn("expired", F.coalesce(d < cut, F.lit(False)))


def failed_tickers(errors: DataFrame, metadata: DataFrame) -> DataFrame:
    """Failed tickers from the error table and the stage metadata's lists."""
    a = errors.select(F.col("ticker"), F.lit("error_log").alias("source"))
    b = metadata.select(F.explode("failed_tickers").alias("ticker"), F.lit("metadata").alias("source"))
    return a.unionByName(b).groupBy("ticker").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def throttling_check(meta: DataFrame) -> DataFrame:
    """Rate-limit rules on fetch metadata (M16): any hits; total sleep above 300 s."""
    return meta.select("*", (F.coalesce(F.col("rate_limit_hits"), F.lit(0)) > 0).alias("rate_limited"),
                       (F.coalesce(F.col("total_sleep_time"), F.lit(0)) > THROTTLE_SLEEP_SECONDS).alias("slow_api"))


def copy_table(spark, src: str, dst: str, fmt: str = "parquet") -> DataFrame:
    """Copy a table between stores and check the counts."""
    df = spark.read.format(fmt).load(src)
    df.write.mode("overwrite").format(fmt).save(dst)
    a = df.agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit("source").alias("k"), "n")
    b = spark.read.format(fmt).load(dst).agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit("copy").alias("k"), "n")
    both = a.unionByName(b)
    return both.agg(F.max(F.when(F.col("k") == "source", F.col("n"))).alias("rows_source"),
                    F.max(F.when(F.col("k") == "copy", F.col("n"))).alias("rows_copy")).withColumn(
        "ok", F.col("rows_source") == F.col("rows_copy"))


def store_metadata(df: DataFrame) -> DataFrame:
    """Metadata of a stored bar table (K6): ticker count, rows, date range, tickers, columns."""
    return df.agg(F.count_distinct("ticker").cast("long").alias("ticker_count"),
                  F.count(F.lit(1)).cast("long").alias("total_rows"),
                  F.min("date").alias("start_date"), F.max("date").alias("end_date"),
                  F.array_sort(F.collect_set("ticker")).alias("tickers")).withColumn(
        "columns", F.lit(",".join(df.columns)))


def store_data(df: DataFrame, root: str) -> DataFrame:
    """Write one bar table as Parquet and CSV, return its metadata row (K6)."""
    df.write.mode("overwrite").parquet(f"{root}/parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{root}/csv")
    return store_metadata(df.sparkSession.read.parquet(f"{root}/parquet"))


def strip_zone(text: Column) -> Column:
    """Zone-stamped text -> wall clock kept, zone dropped."""
    return F.to_timestamp_ntz(F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", ""))


def to_utc(text: Column) -> Column:
    """Zone-stamped text -> the UTC wall clock (P10)."""
    wall = strip_zone(text)
    off = F.regexp_extract(text, r"([+-])(\d{2}):?(\d{2})$", 0)
    sign = F.when(F.substring(off, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.coalesce(F.regexp_extract(text, r"([+-])(\d{2}):?(\d{2})$", 2).try_cast("int"), F.lit(0))
    mm = F.coalesce(F.regexp_extract(text, r"([+-])(\d{2}):?(\d{2})$", 3).try_cast("int"), F.lit(0))
    return wall - F.make_dt_interval(hours=sign * hh, mins=sign * mm)


def first_tickers(df: DataFrame, n: int, key: str = "ticker") -> DataFrame:
    """Test mode (P11): only the first ``n`` tickers in key order (ordered limit + semi-join)."""
    first = df.select(key).distinct().orderBy(key).limit(n)
    return df.join(first, key, "left_semi")


def dropped_tickers(before: DataFrame, after: DataFrame, key: str = "ticker") -> DataFrame:
    """Tickers present before a filter and gone after it."""
    return before.select(key).distinct().join(after.select(key).distinct(), key, "left_anti")
