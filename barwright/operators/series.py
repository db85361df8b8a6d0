"""Skew-safe layout for per-ticker ordered series.

A plain ``Window.partitionBy("ticker")`` sends every row of a ticker to one task, so
one hot ticker holding a third of the table would sit in one task.  This module
splits every series into bounded pieces instead:

* ``index_series``: the 0-based position ``_i`` of each row inside its ticker,
  from per-(ticker, time bucket) counts (a small table) plus a ``row_number``
  inside each bucket.  A bucket holds at most ``bucket_days`` days of one ticker.
* ``block_layout``: block ``_blk = _i div block_rows``; the last ``halo_rows`` rows
  of every block are copied into the next block (``_h = 1``), so any frame that
  looks back at most ``halo_rows`` rows is exact inside ``(ticker, _blk)``.
* ``block_table``: per-(ticker, block) side table (last observation before a block,
  kept rows after it), scanned in two levels (blocks in super-blocks, super-blocks).
* ``ema_family``: exponential means (and a MACD signal) as a two-level block scan.
  Inside a 64-row sub-block the recurrence is a running sum in log space; the carry
  entering each sub-block is an affine prefix over a table 64x smaller than the
  data, folded with ``aggregate`` per group of 64 and recursed while needed.
* ``index_series_ranged``: positions for rows of any density (raw events), from a
  range partitioning that splits a hot key across partitions.

Every table that is shuffled whole is keyed by ``(ticker, _blk)`` or
``(ticker, bucket)``, so no group grows with the length of a series.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.session import keep

BUCKET_DAYS = 64      # rows per (ticker, bucket) <= 64 daily bars, <= 1536 hourly bars
BLOCK_ROWS = 1024     # rows per window partition (plus the halo)
HALO_ROWS = 200       # longest look-back any rolling operator may use (sma_200)
SUB_ROWS = 64         # sub-block of the exponential scan; keeps exp(-P) finite
FANOUT = 64           # group size of the carry fold
LF_FLOOR = -40.0      # ln(1 - w) floor; exp(-40) ~ 4e-18 is below double resolution


@dataclass(frozen=True)
class Layout:
    """``reaching(n)`` sizes the halo (and the block with it) for a look-back of n rows.

    ``by_sub``: windows sort a block by (``_sb``, ``_i``).  That is the order of ``_i``, but one sort
    then serves the frames of blocks and those of sub-blocks (rows need ``with_sub_blocks``)."""
    key: str = "ticker"
    order: str = "date"
    block_rows: int = BLOCK_ROWS
    halo_rows: int = HALO_ROWS
    by_sub: bool = False

    @classmethod
    def reaching(cls, n: int, **kw) -> Layout:
        return cls(halo_rows=max(HALO_ROWS, n), block_rows=max(BLOCK_ROWS, 4 * n), **kw)

    def window(self):
        """Window over one block (own rows and halo), ordered by position."""
        return Window.partitionBy(self.key, "_blk").orderBy(*(["_sb"] if self.by_sub else []), "_i")

    def rows(self, n: int):
        if n - 1 > self.halo_rows:
            raise ValueError(f"look-back {n - 1} exceeds the halo of {self.halo_rows} rows")
        return self.window().rowsBetween(-(n - 1), Window.currentRow)


def index_series(df: DataFrame, key: str = "ticker", order: str = "date",
                 bucket_days: int = BUCKET_DAYS, tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``_i`` (0-based position of the row in its key, by ``order``) and ``_n`` (rows in the key).

    Rows with a NULL key or NULL order value are dropped (they belong to no series).
    """
    day = F.datediff(F.to_date(F.col(order)), F.lit("1970-01-01").cast("date"))
    d = (df.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
           .withColumn("_tb", F.floor(day / F.lit(bucket_days)).cast("long")))
    counts = d.groupBy(key, "_tb").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(key).orderBy("_tb")
    offsets = counts.select(
        key, "_tb",
        (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(key)).alias("_n"))
    order_cols = [F.col(order)] + [F.col(c) for c in (tiebreak or [])]
    rn = F.row_number().over(Window.partitionBy(key, "_tb").orderBy(*order_cols))
    return (d.join(offsets, [key, "_tb"])
             .withColumn("_i", (F.col("_off") + rn - 1).cast("long"))
             .drop("_off", "_tb"))


def index_series_ranged(df: DataFrame, key: str, order: str, tiebreak: list[str] | None = None,
                        parts: int | None = None) -> DataFrame:
    """``_i`` / ``_n`` like ``index_series`` for rows of any density (raw events, ticks).

    ``repartitionByRange(key, order)`` picks partition bounds from a sample, so one hot key
    spans as many partitions as its share of rows needs.  The range-partitioned rows are
    checkpointed (partition ids must not change between the count and the numbering),
    rows are counted per (key, partition) - at most ``parts`` rows per key - and the
    running sum of those counts offsets a ``row_number`` inside each (key, partition).
    """
    from barwright.session import materialize
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tb = [F.col(c) for c in (tiebreak or [])]
    r = materialize(df.filter(F.col(key).isNotNull())
                      .repartitionByRange(parts, F.col(key), F.col(order), *tb)
                      .withColumn("_p", F.spark_partition_id()))
    counts = r.groupBy(key, "_p").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(key).orderBy("_p")
    offsets = counts.select(
        key, "_p",
        (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(key)).alias("_n"))
    rn = F.row_number().over(Window.partitionBy(key, "_p").orderBy(F.col(order), *tb))
    return (r.join(offsets, [key, "_p"])
             .withColumn("_i", (F.col("_off") + rn - 1).cast("long"))
             .drop("_off", "_p"))


def block_layout(indexed: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Explode the halo copies: ``_blk`` = block the row is computed in, ``_h`` = 1 for a copy."""
    k, h = layout.block_rows, layout.halo_rows
    own = F.floor(F.col("_i") / F.lit(k)).cast("long")
    is_tail = (F.col("_i") % F.lit(k)) >= F.lit(k - h)
    next_exists = (own + 1) * F.lit(k) < F.col("_n")
    copies = F.when(is_tail & next_exists, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (indexed.withColumn("_h", F.explode(copies))
                   .withColumn("_blk", own + F.col("_h")))


# ---------------------------------------------------------------------------
# affine prefix (the carry chain)
# ---------------------------------------------------------------------------

def affine_exclusive_prefix(t: DataFrame, key: str, idx: str, pairs: list[tuple[str, str]],
                            max_idx: int, fanout: int = FANOUT) -> DataFrame:
    """For each (key, idx) the value entering element ``idx`` of the recurrence
    ``y = A*y_prev + B`` (y before element 0 is 0), for every (A, B) pair.

    ``idx`` must be dense 0..n-1 per key.  Groups of ``fanout`` elements are folded with
    ``aggregate``; the group totals form the next level, recursing while
    ``max_idx >= fanout``.  Returns columns key, idx, C_0 .. C_{m-1}.
    """
    m = len(pairs)
    elem = F.struct(F.col(idx).alias("i"),
                    *[F.col(a).alias(f"a{j}") for j, (a, _) in enumerate(pairs)],
                    *[F.col(b).alias(f"b{j}") for j, (_, b) in enumerate(pairs)])
    grouped = (t.withColumn("_g", F.floor(F.col(idx) / F.lit(fanout)).cast("long"))
                .groupBy(key, "_g").agg(F.array_sort(F.collect_list(elem)).alias("xs")))
    out_type = "array<struct<i:bigint," + ",".join(
        [f"ea{j}:double" for j in range(m)] + [f"eb{j}:double" for j in range(m)]) + ">>"
    init = F.struct(*[F.lit(1.0).alias(f"A{j}") for j in range(m)],
                    *[F.lit(0.0).alias(f"B{j}") for j in range(m)],
                    F.array().cast(out_type).alias("out"))

    def merge(acc, x):
        return F.struct(
            *[(x[f"a{j}"] * acc[f"A{j}"]).alias(f"A{j}") for j in range(m)],
            *[(x[f"a{j}"] * acc[f"B{j}"] + x[f"b{j}"]).alias(f"B{j}") for j in range(m)],
            F.array_append(acc["out"], F.struct(
                x["i"].cast("long").alias("i"),
                *[acc[f"A{j}"].alias(f"ea{j}") for j in range(m)],
                *[acc[f"B{j}"].alias(f"eb{j}") for j in range(m)])).alias("out"))

    folded = grouped.select(key, "_g", F.aggregate("xs", init, merge).alias("r"))
    elems = folded.select(key, "_g", F.inline(F.col("r.out")))
    if max_idx < fanout:
        return elems.select(key, F.col("i").alias(idx),
                            *[F.col(f"eb{j}").alias(f"C_{j}") for j in range(m)])
    upper = folded.select(key, F.col("_g").alias("_u"),
                          *[F.col(f"r.A{j}").alias(f"UA{j}") for j in range(m)],
                          *[F.col(f"r.B{j}").alias(f"UB{j}") for j in range(m)])
    up = affine_exclusive_prefix(upper, key, "_u", [(f"UA{j}", f"UB{j}") for j in range(m)],
                                 max_idx // fanout, fanout)
    joined = elems.join(up.withColumnRenamed("_u", "_g"), [key, "_g"])
    return joined.select(key, F.col("i").alias(idx),
                         *[(F.col(f"ea{j}") * F.col(f"C_{j}") + F.col(f"eb{j}")).alias(f"C_{j}")
                           for j in range(m)])


# ---------------------------------------------------------------------------
# exponential mean
# ---------------------------------------------------------------------------

def _sub_window(layout: Layout):
    return (Window.partitionBy(layout.key, "_blk", "_sb").orderBy("_i")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def with_sub_blocks(df: DataFrame, layout: Layout) -> DataFrame:
    """``_sb``: sub-block of an own row inside its block; -1 for halo copies."""
    return df.withColumn("_sb", F.when(F.col("_h") == 0,
                                       F.floor((F.col("_i") % F.lit(layout.block_rows)) / F.lit(SUB_ROWS))
                                       ).otherwise(F.lit(-1)).cast("long"))


def ends_sub_block(layout: Layout) -> Column:
    """The last own row of a sub-block."""
    pos = F.col("_i") % F.lit(layout.block_rows) + 1
    last = (pos % F.lit(SUB_ROWS) == 0) | (pos == layout.block_rows) | (F.col("_i") + 1 == F.col("_n"))
    return (F.col("_h") == 0) & last


SUPER_BLOCKS = 1024   # blocks per super-block in the two-level scans of the block table


def block_table(layout_df: DataFrame, layout: Layout, value: str | None = None,
                keep: Column | None = None) -> DataFrame:
    """Small per-(ticker, block) table: ``_pobs_blk`` = position of the last non-NULL ``value``
    in all earlier blocks, ``_kin`` and ``_kafter`` = rows passing ``keep`` in the block itself and in
    all later blocks.

    Both are scans over the blocks of a ticker, done in two levels so no window holds more
    than ``SUPER_BLOCKS`` rows or the super-blocks of one ticker (data / 1M rows)."""
    key = layout.key
    own = layout_df.filter(F.col("_h") == 0)
    aggs = []
    if value is not None:
        aggs.append(F.max(F.when(F.col(value).isNotNull(), F.col("_i"))).alias("_m"))
    if keep is not None:
        aggs.append(F.sum(F.when(keep, 1).otherwise(0)).cast("long").alias("_k"))
    per_blk = (own.groupBy(key, "_blk").agg(*aggs)
                  .withColumn("_sup", F.floor(F.col("_blk") / F.lit(SUPER_BLOCKS)).cast("long")))
    sup_aggs = ([F.max("_m").alias("_sm")] if value is not None else []) + \
               ([F.sum("_k").alias("_sk")] if keep is not None else [])
    per_sup = per_blk.groupBy(key, "_sup").agg(*sup_aggs)
    ws = Window.partitionBy(key).orderBy("_sup")
    sup_cols = [key, "_sup"]
    if value is not None:
        sup_cols.append(F.max("_sm").over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_sm_before"))
    if keep is not None:
        sup_cols.append(F.coalesce(F.sum("_sk").over(ws.rowsBetween(1, Window.unboundedFollowing)),
                                   F.lit(0)).alias("_sk_after"))
    sup = per_sup.select(*sup_cols)
    wb = Window.partitionBy(key, "_sup").orderBy("_blk")
    j = per_blk.join(sup, [key, "_sup"], "left")
    cols = [key, "_blk"]
    if value is not None:
        in_sup = F.max("_m").over(wb.rowsBetween(Window.unboundedPreceding, -1))
        cols.append(F.greatest(in_sup, F.col("_sm_before")).alias("_pobs_blk"))
    if keep is not None:
        in_sup = F.coalesce(F.sum("_k").over(wb.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
        cols += [F.col("_k").alias("_kin"), (in_sup + F.col("_sk_after")).cast("long").alias("_kafter")]
    return j.select(*cols)


def prev_observation(value: str, layout: Layout) -> Column:
    """Position of the last earlier row whose ``value`` is not NULL.  Needs ``_pobs_blk``
    from ``block_table`` for gaps longer than the halo."""
    obs_i = F.when(F.col(value).isNotNull(), F.col("_i"))
    in_blk = F.last(obs_i, ignorenulls=True).over(
        layout.window().rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(in_blk, F.col("_pobs_blk"))


def _weights(x: Column, prev: Column, span: float):
    """(lf, w) of one row: y = (1-w) y_prev + w x with ln(1-w) = lf; pandas adjust=False,
    ignore_na=False weights for a gap of g = i - prev rows."""
    alpha = 2.0 / (float(span) + 1.0)
    q = 1.0 - alpha
    lnq = math.log(q) if q > 0 else -1e9
    obs = x.isNotNull()
    g = (F.col("_i") - prev).cast("double")
    qg = F.pow(F.lit(q), g)
    lf = F.when(obs & prev.isNotNull(),
                F.greatest(F.lit(LF_FLOOR), g * F.lit(lnq) - F.log(F.lit(alpha) + qg))
                ).otherwise(F.lit(0.0))
    w = (F.when(obs & prev.isNull(), F.lit(1.0))
          .when(obs, F.lit(alpha) / (F.lit(alpha) + qg))
          .otherwise(F.lit(0.0)))
    return lf, w


def _fused_carries(summary: DataFrame, key: str, m: int, jf: int, js: int) -> DataFrame:
    """Carries entering every sub-block for ``m`` exponential means and the signal, when a
    ticker has fewer than ``FANOUT`` sub-blocks (one bounded array per ticker).  The signal's
    step needs the fast / slow carries at the same sub-block, so all run in one fold; the
    multiply-adds are those of ``affine_exclusive_prefix``, in the same order."""
    elem = F.struct(F.col("_s").alias("i"),
                    *[F.exp(F.col(f"e.P{j}")).alias(f"a{j}") for j in range(m)],
                    *[F.col(f"e.L{j}").alias(f"b{j}") for j in range(m)],
                    F.exp(F.col("e._P_sig")).alias("a9"), F.col("e._sig_a").alias("sa"),
                    F.col("e._sig_b").alias("sb"), F.col("e._sig_c").alias("sc"))
    grouped = summary.groupBy(key).agg(F.array_sort(F.collect_list(elem)).alias("xs"))
    out_type = "array<struct<_s:bigint," + ",".join([f"c{j}:double" for j in range(m)] + ["c9:double"]) + ">>"
    init = F.struct(*[F.lit(0.0).alias(f"y{j}") for j in range(m)], F.lit(0.0).alias("y9"),
                    F.array().cast(out_type).alias("out"))

    def merge(acc, x):
        cf, cs = acc[f"y{jf}"], acc[f"y{js}"]
        b9 = x["a9"] * (x["sa"] + cf * x["sb"] - cs * x["sc"])
        return F.struct(*[(x[f"a{j}"] * acc[f"y{j}"] + x[f"b{j}"]).alias(f"y{j}") for j in range(m)],
                        (x["a9"] * acc["y9"] + b9).alias("y9"),
                        F.array_append(acc["out"], F.struct(
                            x["i"].cast("long").alias("_s"), *[acc[f"y{j}"].alias(f"c{j}") for j in range(m)],
                            acc["y9"].alias("c9"))).alias("out"))

    return grouped.select(key, F.inline(F.aggregate("xs", init, merge)["out"]))


def ema_family(df: DataFrame, layout: Layout, value: str, prev: Column, spans: dict[str, float],
               max_rows: int, signal: tuple[str, float, str, str] | None = None,
               seeds: dict[str, str] | None = None,
               narrow: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Exponential means of ``value`` (``ewm(span, adjust=False).mean()``), one column per
    ``spans`` entry, and optionally ``signal = (name, span, fast, slow)``: the exponential
    mean of ``fast - slow``.

    ``prev`` = position of the previous observation of ``value`` (NULL if none).  Missing
    values follow pandas ``ignore_na=False``: the mean repeats over a NULL, and an
    observation after a gap of g rows gets weight alpha / (alpha + (1-alpha)^g).  NULL
    until the first observation.  ``df`` must carry ``_sb`` (``with_sub_blocks``).
    ``seeds`` continue a series: per mean a column that holds, on the first observation of a
    ticker, the value that the mean has there (NULL: the observation itself); for the signal its
    value on any one row, from which it goes on.
    ``narrow`` is given the rows with their local sums and returns those whose means are wanted
    (further columns may be added); rows that end a sub-block (``ends_sub_block``) must stay, as
    the carries come from them.  Only what it returns is kept and joined.

    One window pass computes, per 64-row sub-block, running sums with zero carry; the
    carry entering each sub-block is resolved on the per-sub-block summary table (64x
    smaller); one join on (ticker, block) brings the carries back.  The signal's local sums
    are split into a part independent of the fast/slow carries and two parts linear in
    them, so it needs no second pass over the data.
    """
    key = layout.key
    ws = _sub_window(layout)
    x = F.col(value)
    names = list(spans)
    started = x.isNotNull() | prev.isNotNull()
    seeded = lambda n: [F.col(seeds[n])] if seeds and n in seeds else []
    lvl_p, lvl_l, lvl_s = {}, {}, {}
    for n in names:
        lf, w = _weights(x, prev, spans[n])
        lvl_p[f"_P_{n}"] = F.sum(lf).over(ws)
        lvl_l[f"_L_{n}"] = F.exp(F.col(f"_P_{n}")) * F.sum(
            w * F.coalesce(*seeded(n), x, F.lit(0.0)) * F.exp(-F.col(f"_P_{n}"))).over(ws)
    if signal is not None:
        sname, sspan, fast, slow = signal
        # the signal's input is present from the first observation on, one row apart
        sprev = F.when(prev.isNotNull(), F.col("_i") - 1)
        lf9, w9 = _weights(F.when(started, F.lit(0.0)), sprev, sspan)
        at_seed = F.coalesce(*[c.isNotNull() for c in seeded(sname)], F.lit(False))
        lf9, w9 = F.when(at_seed, F.lit(LF_FLOOR)).otherwise(lf9), F.when(at_seed, F.lit(1.0)).otherwise(w9)
        lvl_p["_P_sig"] = F.sum(lf9).over(ws)
        e9 = F.exp(-F.col("_P_sig"))
        linear = F.when(at_seed, F.lit(0.0)).otherwise(w9)  # a seed does not depend on the carries
        lvl_s = {"_sig_a": F.sum(w9 * F.coalesce(*seeded(sname), F.col(f"_L_{fast}") - F.col(f"_L_{slow}")) * e9).over(ws),
                 "_sig_b": F.sum(linear * F.exp(F.col(f"_P_{fast}")) * e9).over(ws),
                 "_sig_c": F.sum(linear * F.exp(F.col(f"_P_{slow}")) * e9).over(ws)}
    df = df.withColumns(lvl_p).withColumns(lvl_l)
    if lvl_s:
        df = df.withColumns(lvl_s)
    if narrow is not None:
        df = narrow(df)

    # the local sums feed both the summary and the final columns: compute them once; the
    # cached scan keeps the (ticker, block) partitioning, so the carry join shuffles only carries
    df = keep(df)
    # one summary row per sub-block (own rows only)
    subs_per_blk = layout.block_rows // SUB_ROWS
    fields = [F.col(f"_P_{n}").alias(f"P{j}") for j, n in enumerate(names)] + \
             [F.col(f"_L_{n}").alias(f"L{j}") for j, n in enumerate(names)]
    if signal is not None:
        fields += [F.col(c).alias(c) for c in ("_P_sig", "_sig_a", "_sig_b", "_sig_c")]
    summary = (df.filter(F.col("_h") == 0)
                 .groupBy(key, "_blk", "_sb").agg(F.max_by(F.struct(*fields), F.col("_i")).alias("e"))
                 .select(key, (F.col("_blk") * subs_per_blk + F.col("_sb")).alias("_s"), "e"))
    max_s = max(max_rows - 1, 0) // SUB_ROWS
    flat = summary.select(key, "_s",
                          *[F.exp(F.col(f"e.P{j}")).alias(f"A{j}") for j in range(len(names))],
                          *[F.col(f"e.L{j}").alias(f"B{j}") for j in range(len(names))])
    if signal is not None and max_s < FANOUT:
        # every ticker fits one fold: fast, slow and signal carries in one sequential pass
        carries = _fused_carries(summary, key, len(names), names.index(signal[2]), names.index(signal[3]))
        carry_cols = [F.col(f"c{j}") for j in range(len(names))] + [F.col("c9")]
    else:
        carries = affine_exclusive_prefix(flat, key, "_s", [(f"A{j}", f"B{j}") for j in range(len(names))],
                                          max_idx=max_s)
        carry_cols = [F.col(f"C_{j}").alias(f"c{j}") for j in range(len(names))]
    if signal is not None and not max_s < FANOUT:
        jf, js = names.index(fast), names.index(slow)
        sig = (summary.join(carries, [key, "_s"])
                      .select(key, "_s", F.col(f"C_{jf}").alias("cf"), F.col(f"C_{js}").alias("cs"),
                              F.exp(F.col("e._P_sig")).alias("A9"),
                              (F.exp(F.col("e._P_sig")) * (F.col("e._sig_a") + F.col(f"C_{jf}") * F.col("e._sig_b")
                                                          - F.col(f"C_{js}") * F.col("e._sig_c"))).alias("B9")))
        sig_c = affine_exclusive_prefix(sig.select(key, "_s", "A9", "B9"), key, "_s", [("A9", "B9")],
                                        max_idx=max_s)
        carries = carries.join(sig_c.withColumnRenamed("C_0", "_c9"), [key, "_s"])
        carry_cols.append(F.col("_c9").alias("c9"))
    per_blk = (carries.withColumn("_blk", F.floor(F.col("_s") / F.lit(subs_per_blk)).cast("long"))
                      .groupBy(key, "_blk")
                      .agg(F.array_sort(F.collect_list(F.struct("_s", *carry_cols))).alias("_carr")))
    df = df.join(per_blk, [key, "_blk"], "left")
    pos = F.greatest(F.col("_sb") + 1, F.lit(1)).cast("int")
    carr = F.try_element_at(F.col("_carr"), pos)
    live = started & (F.col("_h") == 0)
    final = {n: F.when(live, F.col(f"_L_{n}") + F.exp(F.col(f"_P_{n}")) * carr[f"c{j}"])
             for j, n in enumerate(names)}
    if signal is not None:
        cf, cs = carr[f"c{names.index(fast)}"], carr[f"c{names.index(slow)}"]
        final[sname] = F.when(live, F.exp(F.col("_P_sig")) * (
            F.col("_sig_a") + cf * F.col("_sig_b") - cs * F.col("_sig_c") + carr["c9"]))
    df = df.withColumns(final).drop("_P_sig", "_sig_a", "_sig_b", "_sig_c",
                                    *[f"_P_{n}" for n in names], *[f"_L_{n}" for n in names])
    return df.drop("_carr")
