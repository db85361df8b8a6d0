"""barwright: time-series bar tables, indicators and table-quality operators on Spark.

Every operator takes and returns a DataFrame (or a Column); nothing passes rows
through the driver.  Series are keyed by ``ticker`` and ordered by ``date``.
"""

__version__ = "0.1.0"
