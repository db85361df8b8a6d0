"""History of bars as versions of (year, ticker bucket) directories under a manifest (S2, K2, M2, ST1).

``data/v=<version>/year=<y>/bucket=<b>/`` holds the rows of a year and a bucket of tickers, sorted
by ticker and date.  A write never touches files that a reader may hold: it writes the merged rows
of the buckets it changes to a new version and then adds a manifest, in one step, that names for
every (year, bucket) the version that is valid.  A reader takes the newest manifest.

A manifest also names the last batch of every source that it holds, so a batch that comes again,
after a failure anywhere, changes nothing.  Two writers at once: the manifest of the second is
refused, and its batch may be repeated.

What passes the driver is the manifest: one entry per (year, bucket), never per row or ticker."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.operators.history import upsert_keep_last
from barwright.sources import fs

BARS = "ticker string, date timestamp_ntz, open double, high double, low double, close double, volume double"
BUCKETS = 16
#: rows of a file at most (about 60 MB of bars)
FILE_ROWS = 2_000_000


class Conflict(RuntimeError):
    """Another writer has added a manifest in the meantime."""


class HistoryStore:
    """``buckets``: ticker buckets of a year, fixed when the store is made (at 100 TB some
    thousands, so that a bucket of a year stays within a few GB)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        if not fs.exists(spark, f"{self.root}/manifests"):
            empty = {"version": 0, "buckets": buckets, "live": [], "batches": {},
                     "schema": json.loads(spark.createDataFrame([], BARS).schema.json())}
            fs.create_document(spark, self._manifest_path(0), json.dumps(empty))

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def manifest(self) -> dict:
        """Newest manifest: version, buckets, live [(year, bucket, version)], batches {source: id}."""
        names = [n for n, is_dir in fs.children(self.spark, f"{self.root}/manifests") if not is_dir and n.endswith(".json") and n[0] != "."]
        return json.loads(fs.read_document(self.spark, f"{self.root}/manifests/{names[-1]}"))

    def bucket(self, ticker: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(ticker), F.lit(buckets)).cast("int")

    def _scan(self, m: dict, live: list) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        if not live:
            return self.spark.createDataFrame([], schema).select("*", F.lit(None).cast("int").alias("year"))
        at = T.StructType([*schema.fields, T.StructField("v", T.StringType()), T.StructField("year", T.IntegerType()),
                           T.StructField("bucket", T.IntegerType())])
        paths = [f"{self.root}/data/v={v}/year={y}/bucket={b}" for y, b, v in live]
        df = self.spark.read.schema(at).option("basePath", f"{self.root}/data").parquet(*paths)
        # said again as a filter on the partition columns: the plan shows what is pruned
        return df.where(F.col("year").isin(sorted({y for y, _, _ in live}))).drop("v", "bucket")

    def read(self, years: list[int] | None = None, tickers: list[str] | DataFrame | None = None) -> DataFrame:
        """Rows of the history with their ``year``.  ``years`` and a list of ``tickers`` choose
        directories, and the tickers are pushed into the scan; a DataFrame of tickers is joined."""
        m = self.manifest()
        live = [x for x in m["live"] if years is None or x[0] in years]
        if isinstance(tickers, list):
            rows = self.spark.createDataFrame([(t,) for t in tickers], "t string").select(self.bucket(F.col("t"), m["buckets"])).distinct().collect()
            wanted = {r[0] for r in rows}
            return self._scan(m, [x for x in live if x[1] in wanted]).where(F.col("ticker").isin(tickers))
        df = self._scan(m, live)
        return df if tickers is None else df.join(tickers.select("ticker").distinct(), "ticker", "left_semi")

    def upsert(self, rows: DataFrame, batch: tuple[str, int] | None = None, seq: str | None = None) -> str:
        """Merge rows: per (ticker, date) the new row wins over the stored one and, among the new
        ones, the last by ``seq`` (U2).  Rows without ticker or date belong to no series and are
        not stored.  ``batch`` = (source, number): ``skipped`` if that number or a later one of
        the source is stored already, ``empty`` if there is no row, else ``written``."""
        m = self.manifest()
        if batch is not None and m["batches"].get(batch[0], -1) >= batch[1]:
            return "skipped"
        rows = rows.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
        place = (F.year("date").alias("year"), self.bucket(F.col("ticker"), m["buckets"]).alias("bucket"))
        touched = {(r["year"], r["bucket"]) for r in rows.select(*place).distinct().collect()}
        if not touched and batch is None:
            return "empty"
        version = m["version"] + 1
        live = {(y, b): v for y, b, v in m["live"]}
        schema = m["schema"]
        if touched:
            current = self._scan(m, [(y, b, v) for (y, b), v in sorted(live.items()) if (y, b) in touched]).drop("year")
            merged = upsert_keep_last([current, rows], seq=seq)
            name = f"{version:012d}-{os.urandom(4).hex()}"  # a failed attempt leaves a version that no manifest names
            schema = json.loads(merged.schema.json())
            (merged.select("*", *place).repartitionByRange("year", "bucket", "ticker", "date")
             .sortWithinPartitions("year", "bucket", "ticker", "date").write.partitionBy("year", "bucket")
             .option("maxRecordsPerFile", FILE_ROWS).parquet(f"{self.root}/data/v={name}"))
            live |= dict.fromkeys(touched, name)
        batches = m["batches"] | ({batch[0]: batch[1]} if batch else {})
        new = {"version": version, "buckets": m["buckets"], "schema": schema, "batches": batches,
               "live": [[y, b, v] for (y, b), v in sorted(live.items())]}
        if not fs.create_document(self.spark, self._manifest_path(version), json.dumps(new)):
            raise Conflict(f"version {version} of {self.root} was written by another writer")
        return "written" if touched else "empty"

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions that none of the ``keep`` newest manifests names, and older manifests;
        returns the number of deleted versions.  Not while a writer is at work."""
        names = [n for n, _ in fs.children(self.spark, f"{self.root}/manifests") if n.endswith(".json") and n[0] != "."]
        kept = {v for n in names[-keep:] for _, _, v in json.loads(fs.read_document(self.spark, f"{self.root}/manifests/{n}"))["live"]}
        for n in names[:-keep]:
            fs.delete(self.spark, f"{self.root}/manifests/{n}")
        gone = [d for d in fs.subdirectories(self.spark, f"{self.root}/data", "v=") if d[2:] not in kept]
        for d in gone:
            fs.delete(self.spark, f"{self.root}/data/{d}")
        return len(gone)
