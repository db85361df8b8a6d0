"""Landed bars (S1, S3): ``raw/dt=YYYY-MM-DD/<TICKER>.csv``, or files under ``ticker=`` directories.

Every file is parsed by its own header.  The lines of all files are scanned as text with their file
and block; a header table (one row per file: the places of its columns) is joined by path, and each
line is split once and read at those places.  No list of files passes the driver; a ``dt`` is a
literal directory.  The order of the lines is kept as ``_seq`` = (dt, file, block start, row in
block), which says which of several rows of one key is the last one (U2)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.functions.nulls import nan_to_null
from barwright.operators.bars import BASE_COLUMNS, VENDOR_ALIASES
from barwright.session import materialize
from barwright.sources import fs

NUMBERS = ("open", "high", "low", "close", "volume")
#: files whose headers are broadcast (a row has about 300 bytes); beyond it the join shuffles
BROADCAST_FILES = 100_000


class NoLandedData(FileNotFoundError):
    """There is no landed partition to read."""


def landed_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates of the ``dt=`` directories under ``root``, ascending; other names are skipped."""
    out = []
    for name in fs.subdirectories(spark, root, "dt="):
        try:
            out.append(datetime.date.fromisoformat(name[3:]).isoformat())
        except ValueError:
            continue
    return out


def landed_paths(spark: SparkSession, root: str, dt: str | tuple[str, str] | None = None) -> list[str]:
    """Directories of a date, of a range of dates (both ends included), of the ``latest`` date, or
    of all.  No partition at all, or none of the asked ones, raises ``NoLandedData``."""
    dates = landed_dates(spark, root)
    if not dates:
        raise NoLandedData(f"no landed partitions under {root}")
    if dt == "latest":
        dates = dates[-1:]
    elif isinstance(dt, tuple):
        dates = [d for d in dates if dt[0] <= d <= dt[1]]
    elif dt is not None:
        dates = [d for d in dates if d == str(dt)]
    if not dates:
        raise NoLandedData(f"no landed partition dt={dt} under {root}")
    return [root] if dt is None else [f"{root}/dt={d}" for d in dates]


def file_lines(reader: DataFrame) -> DataFrame:
    """Lines of a text scan (batch, or a micro-batch of a stream) with their place: file, start of
    the block, row in the order of the scan."""
    return reader.select("value", F.col("path"), F.col("start"), F.monotonically_increasing_id().alias("row"))


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(paths)
    return file_lines(text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")))


def _cells(line: Column, n: int) -> Column:
    """The ``n`` first cells of a CSV line (missing ones null)."""
    names = [f"c{i}" for i in range(n)]
    row = F.from_csv(line, ", ".join(f"{c} string" for c in names), {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    return F.array(*[row[c] for c in names])


def column_name(header: Column) -> Column:
    """Name of a column as we use it: lower case, vendor spellings mapped, blanks as underscores."""
    name = F.lower(F.trim(F.regexp_replace(header, "﻿", "")))
    known = F.create_map(*[F.lit(x) for kv in VENDOR_ALIASES.items() for x in kv])
    return F.coalesce(known[name], F.replace(name, F.lit(" "), F.lit("_")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Bars of ``file_lines``: ticker, date, prices and volume (double; NaN and unreadable numbers
    are null), further columns of any header as text, ``dt`` (null outside a ``dt=`` directory)
    and ``_seq``.  A column that a file's header lacks is null in its rows; of two columns of one
    name the first counts.  Empty lines and repeats of the header are no rows.  Quoted line
    breaks are not read as one line."""
    heads = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("path").agg(F.min_by("value", "row").alias("header"))
    # a quoted comma only makes this bound larger
    heads = materialize(heads.withColumn("n", F.size(F.split("header", ","))))
    found = heads.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("files")).first()
    width = found["n"] or 1
    names = F.transform(_cells(F.col("header"), width), column_name)
    heads = heads.withColumn("names", names)
    # distinct column names of all headers: as many as the vendors have, not as there are files
    known = [r[0] for r in heads.select(F.explode("names").alias("c")).where("c IS NOT NULL AND c <> ''").distinct().collect()]
    columns = [*BASE_COLUMNS, *sorted(set(known) - set(BASE_COLUMNS) - {"dt", "_seq"})]
    place = F.struct(*[F.array_position("names", F.lit(c)).cast("int").alias(c) for c in columns])
    heads = heads.select("path", "header", place.alias("at"))
    if found["files"] <= BROADCAST_FILES:
        heads = F.broadcast(heads)
    rows = lines.join(heads, "path").where((F.trim("value") != "") & (F.col("value") != F.col("header")))
    rows = rows.withColumn("cells", _cells(F.col("value"), width))
    cell = {c: F.when(F.col(f"at.`{c}`") > 0, F.try_element_at("cells", F.col(f"at.`{c}`"))) for c in columns}
    stem = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    held = F.regexp_extract("path", r"/ticker=([^/]+)/", 1)
    decoded = lambda c: F.coalesce(F.try_url_decode(c), c)
    # paths of file metadata are URI-encoded, and names of partition directories are escaped once more
    from_path = decoded(decoded(F.when(held != "", held).otherwise(stem)))
    ticker = F.coalesce(cell["ticker"], from_path) if "ticker" in columns else from_path
    dt = F.try_to_date(F.regexp_extract("path", r"/dt=([^/]+)/", 1), "yyyy-MM-dd")
    number = lambda c: nan_to_null(c.try_cast("double"))
    further = [c for c in columns if c not in (*BASE_COLUMNS, "ticker")]
    return rows.select(
        ticker.alias("ticker"), cell["date"].try_cast("timestamp_ntz").alias("date"), *[number(cell[c]).alias(c) for c in NUMBERS],
        *[cell[c].alias(c) for c in further], dt.alias("dt"), F.struct(dt.alias("dt"), "path", "start", "row").alias("_seq"))


def read_landed(spark: SparkSession, root: str, dt: str | tuple[str, str] | None = None) -> DataFrame:
    """Landed bars of one date, a range of dates, the ``latest`` date or all dates (see
    ``landed_paths``, ``parse_lines``)."""
    return parse_lines(scan_lines(spark, landed_paths(spark, root, dt)))


def write_ticker_files(df: DataFrame, root: str, dt: str, order: list[str] = ("date",)) -> list[str]:
    """Bars of one landing as ``root/dt=<dt>/<TICKER>.csv``, one file per ticker with a header, rows
    in the given order (K3).  Spark writes one file per ticker; the driver renames them, one call
    per ticker.  An earlier landing of the date is replaced.  Returns the file names."""
    spark = df.sparkSession
    base, temp = f"{root}/dt={dt}", f"{root}/.landing-{dt}"
    fs.delete(spark, temp)
    columns = [F.col(c) for c in df.columns if c != "ticker"]
    (df.select(F.col("ticker"), *columns).repartition("ticker").sortWithinPartitions("ticker", *order)
     .write.partitionBy("ticker").option("header", True).csv(temp))
    fs.delete(spark, base)
    out = []
    for name in fs.subdirectories(spark, temp, "ticker="):
        files = [n for n, _ in fs.children(spark, f"{temp}/{name}") if n.endswith(".csv")]
        fs.rename(spark, f"{temp}/{name}/{files[0]}", f"{base}/{name[len('ticker='):]}.csv")
        out.append(f"{name[len('ticker='):]}.csv")
    fs.delete(spark, temp)
    return out
