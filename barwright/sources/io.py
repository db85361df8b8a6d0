"""Readers and writers of the pipeline's tables (S4-S9, S12-S14, K1-K10; landed bars are in
``landed``, the versioned history in ``store``).

Layouts: history Parquet partitioned by ``year`` (ticker as a column, clustered on write);
features Parquet partitioned by ``dt``; JSON documents (metadata, reports, run log) under ``dt=``.  Paths may be any
Hadoop URI (local, s3a://, gs://).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.sources import fs
from barwright.sources.store import BARS

FORMATS = ("parquet", "csv", "json")
#: rows of a written file at most
FILE_ROWS = 2_000_000


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------

def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbol list written by the constituent stage (S4): ``symbol`` (and ``company_name``
    when present), in file order."""
    r = spark.read.option("header", True).csv(path).withColumn("pos", F.monotonically_increasing_id())
    cols = ["pos", "symbol"] + (["company_name"] if "company_name" in r.columns else [])
    return r.select(*cols)


def read_history(spark: SparkSession, root: str, tickers: DataFrame | list[str] | None = None,
                 years: list[int] | None = None) -> DataFrame:
    """Year-partitioned history (S2) with its ``year``; a missing table reads as empty.  ``years``
    and a list of tickers are literal filters: they prune directories and row groups; a DataFrame
    of tickers is joined."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], f"{BARS}, year int")
    h = spark.read.parquet(root)
    if years is not None:
        h = h.where(F.col("year").isin(list(years)))
    if isinstance(tickers, list):
        h = h.where(F.col("ticker").isin(tickers))
    elif tickers is not None:
        h = h.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    return h


def partitions(spark: SparkSession, root: str, column: str = "dt") -> DataFrame:
    """Partitions of a table with their files and bytes (M5, A17): one row per file,
    read from file metadata only (no data columns are scanned).  Directories whose name
    does not parse as a date are ignored."""
    df = spark.read.option("basePath", root).format("binaryFile").load(root)
    p = df.select(F.col("path"), F.col("length").alias("bytes"))
    val = F.regexp_extract(F.col("path"), rf"/{column}=([^/]+)/", 1)
    return (p.withColumn(column, F.try_to_date(val, "yyyy-MM-dd"))
             .filter(F.col(column).isNotNull())
             .select(column, "path", "bytes"))


def partition_profile(files: DataFrame, column: str = "dt") -> DataFrame:
    """Files and MB per partition."""
    return files.groupBy(column).agg(F.count(F.lit(1)).cast("long").alias("files"),
                                     F.round(F.sum("bytes") / 1048576.0, 6).alias("mb"))


def latest_partition(files: DataFrame, column: str = "dt") -> DataFrame:
    """Latest partition value (S3); an empty listing gives one NULL row."""
    return files.agg(F.max(column).alias(f"latest_{column}"))


def read_json_doc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object or array of objects per file."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def stage_metadata(spark: SparkSession, roots: dict[str, str], dt: str) -> DataFrame:
    """Metadata of the stages for one date (S8): one read per stage, tagged, unioned by name."""
    out = None
    for stage, root in roots.items():
        d = read_json_doc(spark, f"{root}/dt={dt}").withColumn("stage", F.lit(stage))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def report_files(spark: SparkSession, root: str, types: list[str] = ("daily", "summary")) -> DataFrame:
    """Report documents ``root/<type>/<stem>.json`` (S9, T5): type, stem, path, bytes, modified; from
    the listing alone."""
    kind = F.regexp_extract("path", r"/([^/]+)/[^/]+\.json$", 1)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
              .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))
    return listed.select(kind.alias("type"), F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("stem"), "path", "bytes",
                         "modified").where(F.col("type").isin(list(types)))


def read_reports(spark: SparkSession, root: str, newest: dict[str, int]) -> DataFrame:
    """The newest report documents of each type by their stem (S9), ``newest`` = {type: how many}:
    type, stem, key ``<type>_<stem>``, document (the JSON text)."""
    files = report_files(spark, root, list(newest))
    most = F.create_map(*[F.lit(x) for kv in newest.items() for x in kv])
    w = Window.partitionBy("type").orderBy(F.desc("stem"))
    chosen = files.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most[F.col("type")])
    # as many paths as the caller asks for
    paths = [r["path"] for r in chosen.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "type string, stem string, key string, document string")
    text = spark.read.text(paths, wholetext=True).select(F.col("value").alias("document"), F.col("_metadata.file_path").alias("path"))
    kind, stem = F.regexp_extract("path", r"/([^/]+)/[^/]+\.json$", 1), F.regexp_extract("path", r"([^/]+)\.json$", 1)
    return text.select(kind.alias("type"), stem.alias("stem"), F.concat(kind, F.lit("_"), stem).alias("key"), "document")


def write_symbols(df: DataFrame, path: str, columns: list[str] = ("symbol", "company_name")) -> None:
    """Symbol list as CSV with a header, in the order of ``pos`` (K4): a constituent list, some
    hundred rows, is one sorted file."""
    df.repartitionByRange(1, "pos").sortWithinPartitions("pos").select(*[c for c in columns if c in df.columns]) \
      .write.mode("overwrite").option("header", True).csv(path)


def retention_plan(spark: SparkSession, roots: dict[str, str], as_of: str, days: int = 30) -> DataFrame:
    """Partitions ``dt=`` of the named trees and whether they are older than ``days`` before
    ``as_of`` (M6): tree, dt, path, expired.  Directory names only; a name that is no date is kept."""
    rows = [(tree, n[3:], f"{root}/{n}") for tree, root in roots.items() for n in fs.subdirectories(spark, root, "dt=")]
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    d = F.try_to_date("name", "yyyy-MM-dd")
    return spark.createDataFrame(rows, "tree string, name string, path string").where(d.isNotNull()).select(
        "tree", d.alias("dt"), "path", (d < cut).alias("expired"))


def retention_apply(spark: SparkSession, roots: dict[str, str], log_root: str, as_of: str, days: int = 30,
                    dry_run: bool = False) -> dict:
    """Delete the expired partitions of a data tree and a log tree (M6, K10) and write the log of it as
    ``log_root/cleanup_<as_of>.json`` (K7); a dry run deletes and writes nothing.  A run that was
    cut off deletes the rest when repeated.  Returns the log."""
    plan = retention_plan(spark, roots, as_of, days).where("expired").orderBy("path").collect()  # one entry per partition
    log = {"cleanup_date": as_of, "retention_days": days, "deleted_partitions": [r["path"] for r in plan],
           "total_deleted": len(plan), "dry_run": dry_run}
    if not dry_run:
        for r in plan:
            fs.delete(spark, r["path"])
        path = f"{log_root}/cleanup_{as_of}.json"
        if not fs.create_document(spark, path, json.dumps(log)):
            fs.delete(spark, path)  # a second cleanup of the day replaces its log
            fs.create_document(spark, path, json.dumps(log))
    return log


def newest_per_type(files: DataFrame, type_col: str, k: int, ts: str = "modified") -> DataFrame:
    """Newest ``k`` report files per type."""
    w = Window.partitionBy(type_col).orderBy(F.col(ts).desc(), F.col("path").desc())
    return files.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------

def write_partitioned(df: DataFrame, root: str, by: list[str], fmt: str = "parquet",
                      cluster: list[str] | None = None, splits: int | None = None, **options) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced (K1, K2).

    Rows go to ranges of (``by``, ``cluster``) with bounds from a sample, so a large partition is
    written by many tasks, and each file holds a narrow range of ``cluster`` (e.g. ticker, date),
    sorted, with row-group bounds that prune.  ``splits``: number of ranges; left out, it follows
    the size (``spark.sql.shuffle.partitions``, small neighbours merged at run time)."""
    order = [F.col(c) for c in (*by, *(cluster or []))]
    out = df.repartitionByRange(splits, *order) if splits else df.repartitionByRange(*order)
    w = out.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*by).format(fmt)
    for k, v in {"partitionOverwriteMode": "dynamic", "maxRecordsPerFile": FILE_ROWS, **options}.items():
        w = w.option(k, v)
    w.save(root)


def write_features(df: DataFrame, root: str, dt: str) -> None:
    """Features for one date (K1)."""
    write_partitioned(df.withColumn("dt", F.lit(dt).cast("date")), root, ["dt"], cluster=["ticker", "date"])


def write_history(df: DataFrame, root: str) -> None:
    """History split by year (K2); only the years present in ``df`` are rewritten.  Write the
    merged rows of the touched years (history U new), never a partial year."""
    write_partitioned(df.withColumn("year", F.year("date")), root, ["year"], cluster=["ticker", "date"])


def write_landed(df: DataFrame, root: str, dt: str, dry_run: bool = False) -> int:
    """Landed bars as CSV with header under dt=/ticker= (K3); dry run writes nothing.
    Returns 0 for a dry run, else 1."""
    if dry_run:
        return 0
    write_partitioned(df.withColumn("dt", F.lit(dt).cast("date")), root, ["dt", "ticker"], "csv",
                      cluster=["date"], header="true")
    return 1


def save(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    """Generic writer (K5): parquet / csv (header) / json records, anything else is an error."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def load(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """Generic reader."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def write_json_doc(df: DataFrame, path: str) -> None:
    """A small document (metadata, errors, diff, report) as JSON under its path (K7): an object for
    one row, an array for several, as ``read_json_doc`` reads it."""
    rows = df.agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("r"))
    text = F.when(F.size("r") == 1, F.to_json(F.col("r")[0])).otherwise(F.to_json("r"))
    rows.select(text.alias("value")).write.mode("overwrite").text(path)


def append_events(df: DataFrame, root: str) -> None:
    """Append structured events, one directory per day (K8)."""
    (df.withColumn("dt", F.to_date("timestamp")).write.mode("append").partitionBy("dt").json(root))


def partition_exists(spark: SparkSession, root: str, column: str, value: str) -> bool:
    """Whether ``root/column=value`` holds any file (K9 skip check); one FS call, driver side."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/{column}={value}")
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    return len(fs.listStatus(p)) > 0


def idempotent_write(df: DataFrame, root: str, dt: str, force: bool = False, fmt: str = "parquet") -> str:
    """Write the ``dt`` partition unless it already has files (K9); returns the status."""
    spark = df.sparkSession
    if not force and partition_exists(spark, root, "dt", dt):
        return "skipped"
    write_partitioned(df.withColumn("dt", F.lit(dt).cast("date")), root, ["dt"], fmt)
    return "written"


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete partition directories (M6 apply step, K10); driver-side FS calls over the plan's
    paths (one per partition, not per row)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    for s in paths:
        p = jvm.org.apache.hadoop.fs.Path(s)
        fs = p.getFileSystem(conf)
        if fs.exists(p) and fs.delete(p, True):
            n += 1
    return n
