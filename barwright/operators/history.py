"""History maintenance: keep-last upsert, high-watermarks, ingest plans, completeness, gaps.

All operators work on one bar table for all tickers; "per ticker" is a grouping key,
never a Python loop.  ``as_of`` is always an argument (no clock reads).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.time import whole_days_between
from barwright.operators.bars import BASE_COLUMNS
from barwright.session import materialize


def _lit_ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz")


def upsert_keep_last(sources: list[DataFrame], key: list[str] = ("ticker", "date"),
                     seq: str | None = None) -> DataFrame:
    """Union ``sources`` (oldest first) and keep, per key, the row of the newest source; inside one
    source the last row by ``seq`` wins (U2): any ordered column, such as the place of a line in
    its file (``_seq`` of ``landed``).  A source without that column is one that holds a key once
    (a history, aggregated bars); should it not, the largest row by its columns is kept, so the
    result never depends on partitioning.

    One aggregate keyed by (ticker, date): ``max_by(row, (src_rank, seq))`` combines
    map-side, so repeated keys are merged before the shuffle.
    """
    key = list(key)
    kinds = [src.schema[seq].dataType for src in sources if seq in src.columns] if seq else []
    if seq and not kinds:
        raise ValueError(f"no source has the sequence column {seq}")
    ranked = None
    for rank, src in enumerate(sources):
        place = F.col(seq) if seq in src.columns else F.lit(None).cast(kinds[0] if kinds else "long")
        s = src.withColumn("_src", F.lit(rank)).withColumn("_place", place)
        if seq in src.columns:
            s = s.drop(seq)
        ranked = s if ranked is None else ranked.unionByName(s, allowMissingColumns=True)
    payload = [c for c in ranked.columns if c not in key + ["_src", "_place"]]
    win = F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct("_src", "_place", *payload)).alias("_w")
    return ranked.groupBy(*key).agg(win).select(*key, *[F.col(f"_w.{c}").alias(c) for c in payload])


def watermark(history: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """Per-ticker high-watermark: latest bar time (A2)."""
    return history.groupBy(key).agg(F.max(order).alias("latest_date"))


def newer_than_watermark(new: DataFrame, wm: DataFrame, key: str = "ticker",
                         order: str = "date") -> DataFrame:
    """Rows strictly newer than their ticker's watermark; tickers without one keep all."""
    return (new.join(wm, key, "left")
               .filter(F.col("latest_date").isNull() | (F.col(order) > F.col("latest_date")))
               .drop("latest_date"))


def completeness(history: DataFrame, universe: DataFrame, min_rows: int = 730,
                 key: str = "ticker") -> DataFrame:
    """Rows per ticker of the universe, complete = rows >= min_rows, missing = max(0, min - rows) (A3)."""
    counts = history.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    n = F.coalesce(F.col("rows"), F.lit(0)).cast("long")
    return (universe.select(key).distinct().join(counts, key, "left")
                    .select(key, n.alias("rows"), (n >= min_rows).alias("complete"),
                            F.greatest(F.lit(min_rows) - n, F.lit(0)).cast("long").alias("missing_days")))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, floored (timedelta.days semantics)."""
    return whole_days_between(later, earlier)


def ingest_plan(universe: DataFrame, history: DataFrame, as_of, days_back: int = 30,
                buffer_days: int = 5, key: str = "ticker") -> DataFrame:
    """Per ticker: no history -> fetch ``days_back`` bars; age <= 1 day -> up to date;
    else request age + ``buffer_days`` days (M1)."""
    wm = watermark(history, key)
    age = days_between(_lit_ts(as_of), F.col("latest_date"))
    action = (F.when(F.col("latest_date").isNull(), F.lit("full"))
               .when(age <= 1, F.lit("up_to_date"))
               .otherwise(F.lit("incremental")))
    request = (F.when(F.col("latest_date").isNull(), F.lit(days_back))
                .when(age <= 1, F.lit(0))
                .otherwise(age + F.lit(buffer_days))).cast("long")
    return (universe.select(key).distinct().join(wm, key, "left")
                    .select(key, "latest_date", age.alias("days_since_update"),
                            action.alias("action"), request.alias("days_to_request")))


def last_rows(df: DataFrame, n: int, key: str = "ticker", order: str = "date") -> DataFrame:
    """Last ``n`` rows per ticker (W13/W14).  ``row_number <= n`` over a descending order is
    planned as a window group limit, so each task keeps only n rows per ticker."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


class Ingest(NamedTuple):
    """``history``: merged bars; ``output``: the last bars per ticker of the universe; ``outcome``:
    per ticker of the universe rows before, rows added and status."""
    history: DataFrame
    output: DataFrame
    outcome: DataFrame


def ingest_apply(history: DataFrame, landed: DataFrame, universe: DataFrame, tail: int = 30,
                 key: str = "ticker", seq: str | None = None) -> Ingest:
    """Apply landed bars to history (M2): keep rows newer than the watermark (P7), upsert (U2), and
    give the last ``tail`` bars of every ticker of the universe, whether it had new bars or not.
    Status: ``updated`` / ``up_to_date`` / ``failed`` (no history and no new rows).

    History and new rows are written once, tagged; the three results are read from that table.
    To store the new rows, ``upsert`` the landed ones into ``sources.store.HistoryStore``."""
    seq = seq or ("_seq" if "_seq" in landed.columns else None)
    fresh = newer_than_watermark(landed, watermark(history, key), key)
    both = materialize(history.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)), allowMissingColumns=True))
    parts = [both.where("NOT _new").drop("_new", *([seq] if seq else [])), both.where("_new").drop("_new")]
    merged = upsert_keep_last(parts, [key, "date"], seq)
    asked = universe.select(key).distinct()
    counts = both.groupBy(key).agg(F.count_if(~F.col("_new")).alias("rows_before"), F.count_if("_new").alias("rows_added"))
    rb, ra = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("rows_before", "rows_added"))
    status = (F.when(ra > 0, F.lit("updated")).when(rb > 0, F.lit("up_to_date"))
               .otherwise(F.lit("failed")))
    outcome = asked.join(counts, key, "left").select(key, rb.alias("rows_before"), ra.alias("rows_added"), status.alias("status"))
    return Ingest(merged, last_rows(merged.join(asked, key, "left_semi"), tail, key), outcome)


def gap_check(history: DataFrame, as_of, key: str = "ticker", max_gap_days: int = 1) -> DataFrame:
    """Tickers whose latest bar is more than ``max_gap_days`` calendar days old (M3)."""
    wm = watermark(history, key)
    gap = F.datediff(F.to_date(_lit_ts(as_of)), F.to_date(F.col("latest_date")))
    return wm.select(key, "latest_date", gap.alias("days_behind"),
                     (gap > max_gap_days).alias("needs_run"))


def previous_in_series(df: DataFrame, key: str = "ticker", order: str = "date",
                       bucket_days: int = 64, out: str = "prev_date") -> DataFrame:
    """``out`` = the previous ``order`` value of the same ticker.

    Inside a (ticker, time bucket) a ``lag``; for a bucket's first row, the last value of
    the nearest earlier bucket, from a small per-bucket table.  No window spans a ticker.
    """
    day = F.datediff(F.to_date(F.col(order)), F.lit("1970-01-01").cast("date"))
    d = df.withColumn("_tb", F.floor(day / F.lit(bucket_days)).cast("long"))
    per_b = d.groupBy(key, "_tb").agg(F.max(order).alias("_bmax"))
    prev_b = per_b.select(key, "_tb", F.lag("_bmax").over(
        Window.partitionBy(key).orderBy("_tb")).alias("_pb"))
    in_b = F.lag(F.col(order)).over(Window.partitionBy(key, "_tb").orderBy(order))
    return (d.join(prev_b, [key, "_tb"], "left")
             .withColumn(out, F.coalesce(in_b, F.col("_pb"))).drop("_tb", "_pb"))


def series_gaps(history: DataFrame, min_gap_days: int = 2, key: str = "ticker",
                order: str = "date") -> DataFrame:
    """Gaps inside each series: consecutive bars more than ``min_gap_days - 1`` days apart (M4)."""
    p = previous_in_series(history.select(key, order), key, order)
    gap = F.datediff(F.to_date(F.col(order)), F.to_date(F.col("prev_date")))
    return (p.filter(F.col("prev_date").isNotNull() & (gap >= min_gap_days))
             .select(key, F.col("prev_date").alias("gap_start"), F.col(order).alias("gap_end"),
                     (gap - 1).cast("long").alias("missing_days")))


def backfill(landed: DataFrame, universe: DataFrame, key: str = "ticker",
             seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Build history from landed bars for many tickers (M13): keep-last per (ticker, date), by
    ``seq`` among repeated rows (``_seq`` of landed files); per-ticker outcome, failures do not
    stop the others."""
    hist = upsert_keep_last([landed], [key, "date"], seq or ("_seq" if "_seq" in landed.columns else None))
    counts = hist.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    n = F.coalesce(F.col("rows"), F.lit(0)).cast("long")
    outcome = (universe.select(key).distinct().join(counts, key, "left")
                       .select(key, n.alias("rows"), (n > 0).alias("ok"),
                               F.when(n == 0, F.lit("no data")).alias("error")))
    return hist, outcome


def source_fallback(primary: DataFrame, secondary: DataFrame, universe: DataFrame, key: str = "ticker",
                    names: tuple[str, str] = ("primary", "secondary")) -> tuple[DataFrame, DataFrame]:
    """Rows of the primary source for tickers that it has, else of the secondary one (S14): (rows with
    their ``source``, (ticker, error) of the universe's tickers that neither has)."""
    have = primary.select(key).distinct()
    rows = primary.withColumn("source", F.lit(names[0])).unionByName(
        secondary.join(have, key, "left_anti").withColumn("source", F.lit(names[1])))
    found = have.unionByName(secondary.select(key).distinct())
    failed = universe.select(key).distinct().join(found, key, "left_anti").withColumn("error", F.lit("no data from any source"))
    return rows, failed


def outcome_summary(outcome: DataFrame, key: str = "ticker", ok: str = "ok",
                    rows: str = "rows", error: str = "error") -> DataFrame:
    """One summary row over a per-ticker outcome table (A9, A19): processed / successful /
    failed counts, success rate text, total rows, status and failed tickers."""
    okc = F.col(ok)
    n_ok = F.count_if(okc)
    n_all = F.count(F.lit(1))
    rate = F.when(n_all > 0, n_ok * F.lit(100.0) / n_all).otherwise(F.lit(0.0))
    return outcome.agg(
        n_all.cast("long").alias("tickers_processed"),
        n_ok.cast("long").alias("tickers_successful"),
        (n_all - n_ok).cast("long").alias("tickers_failed"),
        F.format_string("%.2f%%", rate).alias("success_rate"),
        F.coalesce(F.sum(F.when(okc, F.col(rows))), F.lit(0)).cast("long").alias("total_rows"),
        F.when(n_all - n_ok == 0, F.lit("success")).when(n_ok > 0, F.lit("partial_success"))
         .otherwise(F.lit("failed")).alias("status"),
        F.array_sort(F.collect_list(F.when(~okc, F.col(key)))).alias("failed_tickers"))


def stage_outcome(bars: DataFrame, universe: DataFrame, key: str = "ticker") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcome of a stage that keeps complete bars only (P3, A9): (per ticker rows, rows_dropped, ok,
    error; failures as rows of their own; one summary row).

    Dropped are the bars with a NULL in a base column, and those without a ticker, which belong to
    no series: the latter only show in the summary.  A ticker without any bar has failed."""
    complete = F.lit(True)
    for c in BASE_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    n = F.count(F.lit(1))
    counts = bars.groupBy(key).agg(n.alias("n"), F.count_if(complete & F.col(key).isNotNull()).alias("kept"))
    none = F.coalesce(F.col("n"), F.lit(0)) == 0
    outcome = universe.select(key).distinct().join(counts, key, "left").select(
        key, F.coalesce("kept", F.lit(0)).cast("long").alias("rows"),
        (F.coalesce("n", F.lit(0)) - F.coalesce("kept", F.lit(0))).cast("long").alias("rows_dropped"),
        (~none).alias("ok"), F.when(none, F.lit("no data")).alias("error"))
    failures = outcome.where(~F.col("ok")).select(key, "error")
    lost = counts.agg(F.coalesce(F.sum(F.col("n") - F.col("kept")), F.lit(0)).cast("long").alias("rows_dropped"))
    failed = F.col("tickers_failed")
    # two one-row tables side by side
    summary = outcome_summary(outcome, key).join(lost).withColumn(
        "error_message", F.when(failed > 0, F.concat(F.lit("Failed to process "), failed.cast("string"), F.lit(" tickers"))))
    return outcome, failures, summary


BAR_COLUMNS = ["ticker"] + BASE_COLUMNS
