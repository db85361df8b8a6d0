"""Run-log operators: run statistics, mode breakdown, error distribution, retry and stuck
run selection, stage rollup from checkpoints, formatting helpers.

A run log row: run_id, start_time, end_time (NULL while running), mode, status
('running' / 'completed' / 'failed' / 'terminated'), retry_count, error_message; nested
``checkpoints`` (array of structs) when read from the JSON log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.functions.time import seconds_between as _seconds_between

# Fixed values of the run rules: retries below 3 for daily / weekly runs; a run older than
# 7200 s is stuck; mean runtime above 3600 s warns; dashboard: success below 80 %.
MAX_RETRIES = 3
RETRY_MODES = ("daily", "weekly")
STUCK_SECONDS = 7200
SLOW_RUN_SECONDS = 3600

CHECKPOINT = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("stage", T.StringType()),
    T.StructField("tickers_processed", T.LongType()), T.StructField("total_tickers", T.LongType()),
    T.StructField("progress_percent", T.DoubleType()), T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("estimated_remaining", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType())])
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("start_time", T.StringType()),
    T.StructField("mode", T.StringType()), T.StructField("is_test", T.BooleanType()),
    T.StructField("status", T.StringType()), T.StructField("end_time", T.StringType()),
    T.StructField("exit_code", T.IntegerType()), T.StructField("error_message", T.StringType()),
    T.StructField("retry_count", T.IntegerType()), T.StructField("max_retries", T.IntegerType()),
    T.StructField("checkpoints", T.ArrayType(CHECKPOINT))])


def seconds_between(end: Column, start: Column) -> Column:
    """Duration in seconds with the fraction (F7); independent of the session time zone."""
    return _seconds_between(end, start)


def runs_from_log(log: DataFrame) -> DataFrame:
    """Typed run rows from the JSON run log (text timestamps -> timestamp_ntz)."""
    return log.select("run_id", F.to_timestamp_ntz("start_time").alias("start_time"),
                      F.to_timestamp_ntz("end_time").alias("end_time"), "mode", "status",
                      F.col("retry_count").cast("int").alias("retry_count"), "error_message")


def recent(runs: DataFrame, as_of, days: int) -> DataFrame:
    """Runs started within the last ``days`` days."""
    cut = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))
    return runs.filter(F.col("start_time") >= cut)


def run_stats(runs: DataFrame) -> DataFrame:
    """total, completed, failed, retried, success rate %, mean runtime of ended runs."""
    n = F.count(F.lit(1))
    done = F.count_if(F.col("status") == "completed")
    dur = F.when(F.col("end_time").isNotNull(), seconds_between(F.col("end_time"), F.col("start_time")))
    return runs.agg(n.cast("long").alias("total_runs"), done.cast("long").alias("successful_runs"),
                    F.count_if(F.col("status") == "failed").cast("long").alias("failed_runs"),
                    F.count_if(F.col("retry_count") > 0).cast("long").alias("retried_runs"),
                    F.when(n > 0, done * 100.0 / n).otherwise(F.lit(0.0)).alias("success_rate"),
                    F.coalesce(F.avg(dur), F.lit(0.0)).alias("average_runtime_seconds"))


def runs_by_mode(runs: DataFrame) -> DataFrame:
    """Per mode: total, successful, failed = everything not completed."""
    done = F.count_if(F.col("status") == "completed")
    n = F.count(F.lit(1))
    return runs.groupBy(F.coalesce(F.col("mode"), F.lit("unknown")).alias("mode")).agg(n.cast("long").alias("total"), done.cast("long").alias("successful"),
                                    (n - done).cast("long").alias("failed"))


def error_key(msg: Column) -> Column:
    """Text before the first ';', then before the first '.' (A14)."""
    return F.substring_index(F.substring_index(msg, ";", 1), ".", 1)


def error_distribution(runs: DataFrame) -> DataFrame:
    """Runs per error key, over every run that carries an error message."""
    return (runs.filter(F.col("error_message").isNotNull() & (F.col("error_message") != ""))
                .groupBy(error_key(F.col("error_message")).alias("error_key"))
                .agg(F.count(F.lit(1)).cast("long").alias("n")))


def retry_candidates(runs: DataFrame, max_retries: int = MAX_RETRIES, modes=RETRY_MODES) -> DataFrame:
    """Failed runs with retries left, in a retryable mode."""
    return runs.filter((F.col("status") == "failed") & (F.coalesce(F.col("retry_count"), F.lit(0)) < max_retries)
                       & F.col("mode").isin(*modes))


def stuck_runs(runs: DataFrame, as_of, limit_seconds: int = STUCK_SECONDS) -> DataFrame:
    """Running runs older than ``limit_seconds`` -> proposed status 'terminated' (M12)."""
    el = seconds_between(F.lit(str(as_of)).cast("timestamp_ntz"), F.col("start_time"))
    return (runs.filter((F.col("status") == "running") & (el > limit_seconds))
                .select("run_id", "start_time", "mode", el.alias("elapsed_seconds"),
                        F.lit("terminated").alias("new_status")))


def stage_rollup(runs_with_checkpoints: DataFrame) -> DataFrame:
    """One row per checkpoint of each run (A20): explode the nested checkpoints."""
    return (runs_with_checkpoints.select("run_id", F.explode("checkpoints").alias("c"))
            .select("run_id", "c.stage", F.to_timestamp_ntz("c.timestamp").alias("timestamp"),
                    "c.tickers_processed", "c.total_tickers", "c.progress_percent", "c.elapsed_seconds",
                    "c.status"))


def progress(done: Column, total: Column, elapsed: Column) -> tuple[Column, Column]:
    """(progress %, ETA seconds) with ETA = elapsed / done x left, 0 when nothing is done."""
    pct = F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0))
    eta = F.when(done > 0, elapsed / done * (total - done)).otherwise(F.lit(0.0))
    return pct, eta


def format_time(seconds: Column) -> Column:
    """'x.xs' below a minute, 'x.xm' below an hour, else 'x.xh' (F8)."""
    s = seconds.cast("double")
    one = lambda x: F.round(x * 10.0, 0) / 10.0  # noqa: E731  round first: ties go away from zero
    return (F.when(s < 60, F.format_string("%.1fs", one(s)))
             .when(s < 3600, F.format_string("%.1fm", one(s / 60.0)))
             .otherwise(F.format_string("%.1fh", one(s / 3600.0))))


def format_progress(cur: Column, total: Column, elapsed: Column) -> Column:
    """'c/t (p%) ETA: …' (no ETA before the first item is done); total 0 -> '0/0 (0%)' (F9)."""
    pct, eta = progress(cur.cast("double"), total.cast("double"), elapsed.cast("double"))
    pct1 = F.round(pct * 10.0, 0) / 10.0
    eta_part = F.when(cur > 0, F.concat(F.lit(" ETA: "), format_time(eta))).otherwise(F.lit(""))
    return F.when(total == 0, F.lit("0/0 (0%)")).otherwise(
        F.concat(F.format_string("%d/%d (%.1f%%)", cur.cast("long"), total.cast("long"), pct1), eta_part))


def dashboard_summary(runs: DataFrame, last: int = 10) -> DataFrame:
    """Summary over the last ``last`` runs by start time (A13): totals incl. running count."""
    top = runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(last)
    n = F.count(F.lit(1))
    ok = F.count_if(F.col("status") == "completed")
    dur = F.when(F.col("end_time").isNotNull(), seconds_between(F.col("end_time"), F.col("start_time")))
    return top.agg(n.cast("long").alias("total_runs"), ok.cast("long").alias("successful_runs"),
                   F.count_if(F.col("status") == "failed").cast("long").alias("failed_runs"),
                   F.count_if(F.col("status") == "running").cast("long").alias("running_runs"),
                   F.when(n > 0, ok * 100.0 / n).otherwise(F.lit(0.0)).alias("success_rate"),
                   F.coalesce(F.avg(dur), F.lit(0.0)).alias("average_runtime_seconds"))


def runs_from_events(events: DataFrame) -> DataFrame:
    """A run log derived from an event table: one run per user, first event type -> mode,
    last event type -> status ('error' failed, 'signup' still running, else completed),
    high-value error events -> retries.  One aggregate per user (combined map-side)."""
    order = F.struct("ts", "event_id")
    first = F.min_by("event_type", order)
    last = F.max_by("event_type", order)
    # retries: error events of a high value (above 400)
    n_err = F.count_if((F.col("event_type") == "error") & (F.col("value") > 400))
    mode = (F.when(first.isin("view", "purchase"), F.lit("daily")).when(first == "click", F.lit("weekly"))
             .when(first == "signup", F.lit("test")).otherwise(F.lit("manual")))
    status = (F.when(last == "signup", F.lit("running")).when(last == "error", F.lit("failed"))
               .otherwise(F.lit("completed")))
    msg = F.when(last == "error", F.concat(F.lit("stage "), first, F.lit(" failed. code "),
                                            F.count(F.lit(1)).cast("string"), F.lit("; see log")))
    return events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.min("ts").alias("start_time"),
        F.when(last == "signup", F.lit(None).cast("timestamp_ntz")).otherwise(F.max("ts")).alias("end_time"),
        mode.alias("mode"), status.alias("status"), n_err.cast("int").alias("retry_count"),
        msg.alias("error_message"))


def checkpoints_from_events(events: DataFrame) -> DataFrame:
    """Flat checkpoint rows (the exploded form of A20) from an event table: each event of a
    run is a checkpoint; progress = events so far / events of the run.

    Positions come from the range-partitioned index, so a run holding a large share of
    the events is numbered by many tasks; run starts are a per-run aggregate."""
    from barwright.operators.series import index_series_ranged
    e = events.select("user_id", "event_type", "ts", "event_id")
    idx = index_series_ranged(e, "user_id", "ts", ["event_id"])
    start = events.groupBy("user_id").agg(F.min("ts").alias("_start"))
    k = F.col("_i") + 1
    return idx.join(start, "user_id").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), F.col("ts").alias("timestamp"),
        k.cast("long").alias("tickers_processed"), F.col("_n").cast("long").alias("total_tickers"),
        (k * 100.0 / F.col("_n")).alias("progress_percent"),
        seconds_between(F.col("ts"), F.col("_start")).alias("elapsed_seconds"))
