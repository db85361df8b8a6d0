"""Append-only run log (M9, A20, S7): start, checkpoint and end events of runs, folded to their state.

A run never edits a document: it appends events as JSON lines under ``dt=<date>/``, and the state of
a run is an aggregate over its events, so runs may log from many places at once and a repeated event
changes nothing.  Times are ISO texts with microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators.runs import RUN_LOG, progress

EVENTS = ("run_id string, event string, timestamp string, mode string, is_test boolean, stage string, tickers_processed long, "
          "total_tickers long, elapsed_seconds double, status string, exit_code int, error_message string, retry_count int")
TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event(kind: str, run_id: Column, at: Column, **fields: Column) -> list[Column]:
    """Columns of a start, checkpoint or end event; fields left out are null."""
    known = {"run_id": run_id.cast("string"), "event": F.lit(kind), "timestamp": F.date_format(at, TIME), **fields}
    return [known.get(name, F.lit(None)).cast(t).alias(name) for name, t in (x.split(" ") for x in EVENTS.split(", "))]


def append(events: DataFrame, root: str) -> None:
    """Append events, by date (K8)."""
    events.withColumn("dt", F.substring("timestamp", 1, 10)).write.mode("append").partitionBy("dt").json(root)


def read(spark: SparkSession, root: str, since: str | None = None) -> DataFrame:
    """Events of a log (S7); ``since`` a date: older directories are pruned.  An event that was
    appended twice counts once."""
    df = spark.read.schema(f"{EVENTS}, dt date").json(root)
    if since is not None:
        df = df.where(F.col("dt") >= F.lit(since).cast("date"))
    return df.drop("dt").dropDuplicates()


def states(events: DataFrame) -> DataFrame:
    """State of every run (M9): running until an end event, then completed (exit code 0) or failed,
    with its newest checkpoint.  A run without a start event is known by its id alone."""
    is_ = lambda kind: F.col("event") == kind
    at = F.to_timestamp_ntz("timestamp")
    end = F.max_by(F.struct("exit_code", "error_message"), F.when(is_("end"), F.struct("timestamp", "exit_code")))
    start = F.min_by(F.struct("mode", "is_test", "retry_count"), F.when(is_("start"), F.struct("timestamp", "mode")))
    mark = F.max_by(F.struct("stage", "tickers_processed", "total_tickers", "elapsed_seconds"),
                    F.when(is_("checkpoint"), F.struct("timestamp", "tickers_processed", "stage")))
    s = events.groupBy("run_id").agg(
        F.min(F.when(is_("start"), at)).alias("start_time"), F.max(F.when(is_("end"), at)).alias("end_time"),
        start.alias("s"), end.alias("e"), mark.alias("c"), F.count_if(is_("checkpoint")).alias("checkpoints"))
    pct, eta = progress(F.col("c.tickers_processed"), F.col("c.total_tickers"), F.col("c.elapsed_seconds"))
    status = F.when(F.col("end_time").isNull(), "running").when(F.col("e.exit_code") == 0, "completed").otherwise("failed")
    return s.select("run_id", "start_time", "end_time", "s.mode", "s.is_test", status.alias("status"), "e.exit_code", "e.error_message",
                    F.coalesce("s.retry_count", F.lit(0)).alias("retry_count"), "checkpoints", F.col("c.stage").alias("current_stage"),
                    F.col("c.tickers_processed").alias("tickers_processed"), F.col("c.total_tickers").alias("total_tickers"),
                    pct.alias("progress_percent"), eta.alias("estimated_remaining"))


def checkpoints(events: DataFrame) -> DataFrame:
    """One row per checkpoint event (A20) with progress and estimated time left."""
    pct, eta = progress(F.col("tickers_processed"), F.col("total_tickers"), F.col("elapsed_seconds"))
    return events.where("event = 'checkpoint'").select(
        "run_id", "timestamp", "stage", "tickers_processed", "total_tickers", pct.alias("progress_percent"), "elapsed_seconds",
        eta.alias("estimated_remaining"), "status", "error_message")


def last_runs(events: DataFrame, n: int = 10) -> DataFrame:
    """Documents of the last ``n`` runs by start (S7), with their checkpoints in order, as the JSON
    run log has them (``runs.RUN_LOG``).  Only the checkpoints of these runs are gathered."""
    runs = states(events).where("start_time IS NOT NULL").orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)
    marks = checkpoints(events).join(F.broadcast(runs.select("run_id")), "run_id")  # n rows
    fields = [f.name for f in RUN_LOG["checkpoints"].dataType.elementType]
    marks = marks.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("checkpoints"))
    text = lambda c: F.date_format(c, TIME).alias(c)
    found = runs.drop("checkpoints").join(marks, "run_id", "left")
    return found.select(*[text(f.name) if f.name.endswith("_time") else
                          F.lit(3).alias(f.name) if f.name == "max_retries" else F.col(f.name) for f in RUN_LOG])
