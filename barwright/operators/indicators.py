"""Technical indicators over the block layout, as levels of column expressions.

Every rolling operator uses a row frame inside ``(ticker, _blk)`` ordered by ``_i``
(see ``series``) and the full-window rule: a value only where all ``n`` rows of the
frame hold a value (pandas ``rolling(n)`` with ``min_periods = n``).

An indicator is a list of levels, each a dict ``name -> Column``; a level may only
refer to columns of earlier levels (window functions cannot nest).  ``apply_levels``
merges the levels of many indicators and adds each merged level with one
``withColumns`` call, so a whole feature profile is a handful of projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.nulls import div, full_window
from barwright.operators.series import Layout

Levels = list[dict[str, Column]]


def apply_levels(df: DataFrame, *indicators: Levels, drop_private: bool = True) -> DataFrame:
    depth = max((len(i) for i in indicators), default=0)
    for k in range(depth):
        merged: dict[str, Column] = {}
        for ind in indicators:
            if k < len(ind):
                merged.update(ind[k])
        if merged:
            df = df.withColumns(merged)
    if drop_private:
        private = [n for ind in indicators for lvl in ind for n in lvl if n.startswith("_t_")]
        df = df.drop(*private)
    return df


def rolling(agg, lay: Layout, src: str | Column, n: int) -> Column:
    """``agg`` over the last n rows, only where all n rows hold a value."""
    w = lay.rows(n)
    c = F.col(src) if isinstance(src, str) else src
    return full_window(agg(c).over(w), F.count(c).over(w), n)


#: rows of a partial sum, and the look-back from which means are made of partial sums
STEP, LONG = 10, 30


def sma(lay: Layout, src: str, n: int, out: str) -> Levels:
    """n-row mean, in double for every n.

    A sliding frame is summed anew for every row, n values each time.  A long mean adds the
    ``STEP``-row sums that lie ``STEP`` rows apart (and the few rows left over) instead: n / STEP
    values, no differences of running sums, so nothing cancels.  That the frame is full is seen
    from the position of the last missing value."""
    if n < LONG:
        return [{out: rolling(F.avg, lay, src, n)}]
    if n - 1 > lay.halo_rows:
        raise ValueError(f"look-back {n - 1} exceeds the halo of {lay.halo_rows} rows")
    x, part, gap = F.col(src).cast("double"), f"_t_part_{src}", f"_t_gap_{src}"
    value = F.coalesce(x, F.lit(0.0))
    run = lay.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = lambda c, k: F.lag(c, k).over(lay.window()) if k else c
    terms = [back(F.col(part), k) for k in range(0, n - STEP + 1, STEP)] + [back(value, k) for k in range(n - n % STEP, n)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    full = (F.col("_i") >= n - 1) & (F.col(gap).isNull() | (F.col("_i") - F.col(gap) >= n))
    return [{part: F.sum(value).over(lay.rows(STEP)), gap: F.max(F.when(x.isNull(), F.col("_i"))).over(run)},
            {out: F.when(full, total / F.lit(float(n)))}]


def lag(lay: Layout, src: str, n: int = 1) -> Column:
    if n > lay.halo_rows:
        raise ValueError("lag longer than the halo")
    return F.lag(F.col(src), n).over(lay.window())


def rsi(lay: Layout, src: str = "close", n: int = 14, out: str = "rsi_14") -> Levels:
    """Simple-mean RSI: 100 - 100 / (1 + mean gain / mean loss) over n deltas.

    The missing first delta counts as 0 (so the first value is on row n-1);
    no losses and some gain -> 100; flat -> NULL.  The n-row sums are differences of
    running sums inside the block (O(1) per row); a run of zero losses leaves the
    running sum unchanged, so "no loss" stays exactly 0.
    """
    if n - 1 > lay.halo_rows:
        raise ValueError(f"look-back {n - 1} exceeds the halo of {lay.halo_rows} rows")
    d = F.col(f"_t_d_{out}")
    gain = F.when(d > 0, d).otherwise(F.lit(0.0))
    loss = F.when(d < 0, -d).otherwise(F.lit(0.0))
    run = lay.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sg, sl, k = f"_t_sg_{out}", f"_t_sl_{out}", f"_t_k_{out}"
    full = F.col(k) >= n

    def frame(c):
        return F.col(c) - F.coalesce(F.lag(F.col(c), n).over(lay.window()), F.lit(0.0))

    ag = F.when(full, frame(sg) / F.lit(float(n)))
    al = F.when(full, frame(sl) / F.lit(float(n)))
    val = (F.when((al == 0) & (ag > 0), F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(ag, al))))
    return [{f"_t_d_{out}": F.col(src) - lag(lay, src, 1)},
            {sg: F.sum(gain).over(run), sl: F.sum(loss).over(run), k: F.count(F.lit(1)).over(run)},
            {out: val}]


def bollinger(lay: Layout, src: str = "close", n: int = 20, k: float = 2.0, prefix: str = "bb") -> Levels:
    """Middle = n-row mean, upper / lower = middle +- k * sample standard deviation."""
    m = rolling(F.avg, lay, src, n)
    s = rolling(F.stddev_samp, lay, src, n)
    return [{f"{prefix}_middle": m, f"{prefix}_upper": m + F.lit(k) * s,
             f"{prefix}_lower": m - F.lit(k) * s}]


def bb_width_pctb(prefix: str = "bb", src: str = "close") -> Levels:
    """bb_width = (upper - lower) / middle; bb_pctb = (close - lower) / (upper - lower)."""
    u, lo, m = F.col(f"{prefix}_upper"), F.col(f"{prefix}_lower"), F.col(f"{prefix}_middle")
    return [{f"{prefix}_width": div(u - lo, m), f"{prefix}_pctb": div(F.col(src) - lo, u - lo)}]


def pct_change(lay: Layout, src: str = "close", periods: int = 1, out: str = "price_change") -> Levels:
    return [{out: div(F.col(src), lag(lay, src, periods)) - F.lit(1.0)}]


def momentum(lay: Layout, periods=(1, 5, 10), src: str = "close") -> Levels:
    return [{f"momentum_{p}d": div(F.col(src), lag(lay, src, p)) - F.lit(1.0) for p in periods}]


def volume_ratio(lay: Layout, n: int = 20, src: str = "volume", sma_out: str = "volume_sma",
                 out: str = "volume_ratio") -> Levels:
    """volume_sma = n-row mean of volume (fractional volumes too), volume_ratio = volume / volume_sma."""
    c = F.col(src).cast("double")
    m = rolling(F.avg, lay, c, n)
    return [{sma_out: m, out: div(c, m)}]


def atr(lay: Layout, n: int = 14, out: str = "atr_14") -> Levels:
    """n-row mean of the true range; the first bar's true range is high - low."""
    h, lo, pc = F.col("high"), F.col("low"), F.col(f"_t_pc_{out}")
    tr = F.when(pc.isNull(), h - lo).otherwise(F.greatest(h - lo, F.abs(h - pc), F.abs(lo - pc)))
    return [{f"_t_pc_{out}": lag(lay, "close", 1)}, {out: rolling(F.avg, lay, tr, n)}]


def stochastic(lay: Layout, n: int = 14, d: int = 3, k_out: str = "stoch_k",
               d_out: str = "stoch_d") -> Levels:
    """%K = 100 (close - min low) / (max high - min low) over n rows; %D = d-row mean of %K."""
    ll = rolling(F.min, lay, "low", n)
    hh = rolling(F.max, lay, "high", n)
    k = F.lit(100.0) * div(F.col("close") - ll, hh - ll)
    return [{k_out: k}, {d_out: rolling(F.avg, lay, k_out, d)}]


def tail_flag(lay: Layout, n: int, keep: Column, out: str = "_out", left: str = "_left") -> Levels:
    """``out`` = True for the last ``n`` kept rows of each ticker; ``left`` = kept rows after a row =
    rest of its block (block total ``_kin`` - running count) + ``_kafter`` (later blocks; both from
    ``block_table``).  ``left`` never rises along a block, so the rows with ``left`` < n + m are its
    end, and hold every row that a frame of m rows before a row of the last n can reach."""
    k = F.when(keep, F.lit(1)).otherwise(F.lit(0))
    running = F.sum(k).over(lay.window().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return [{left: F.col("_kin") - running + F.col("_kafter")}, {out: keep & (F.col(left) < n)}]


def kept_rows_per_ticker(df: DataFrame, lay: Layout, keep: str, out: str = "_kept_n") -> DataFrame:
    """Per-ticker number of own rows passing ``keep``, as a small table."""
    return (df.filter((F.col("_h") == 0) & F.col(keep)).groupBy(lay.key)
              .agg(F.count(F.lit(1)).alias(out)))
