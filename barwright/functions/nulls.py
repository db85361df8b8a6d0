"""Null and division rules shared by every operator.

pandas has one missing value (NaN); Spark has NULL and NaN.  Operators work on NULL
only: NaN is turned into NULL on the way in, and divisions follow ``div`` below so
that ANSI mode never raises and the pandas infinities survive where they would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Replace NaN with NULL in every float/double column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def div(a, b) -> Column:
    """a / b with pandas signs: b == 0 gives +inf / -inf by the sign of a, NULL for 0/0."""
    a, b = _c(a), _c(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, F.when(a > 0, F.lit(float("inf")))
                  .when(a < 0, F.lit(float("-inf"))))
            .otherwise(a.cast("double") / b))


def safe_divide(a, b, default: float = 0.0) -> Column:
    """a / b, ``default`` when b is 0 (or the result is not finite); NULL inputs stay NULL."""
    a, b = _c(a), _c(b)
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .otherwise(F.coalesce(q, F.lit(float(default)))))


def full_window(agg: Column, present: Column, n: int) -> Column:
    """``agg`` only where all ``n`` rows of the frame are present (pandas min_periods = n)."""
    return F.when(present == n, agg)
