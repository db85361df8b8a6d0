"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read back.

Stage functions take (spark, docs, sf_dir); all but the last return the columns of ``docs``.

1. quality: documents rejected by the ordinal classifier go (P(good) below one half);
2. near_duplicates: one document of each group of linked ones stays (the smallest id; five-word
   shingles, Jaccard of 0.8 or more); documents without words stay;
3. decontamination: documents with words hit by a benchmark window go;
4. mixing: a document is repeated as often as the mix takes it (0 to 3 times);
5. sharding: every row gets its shard and slot.

Null ids and texts, empty tables and further columns are handled as the operators' docstrings
say; an empty table passes through all stages."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.llm import decontam, jaccard, mixing, quality, sharding
from barwright.session import ensure_checkpoint_dir

SHARDS = 24
#: the classifier, the join and the Feistel network have no SQL form
ORACLE_SQL = None


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def wrapped(docs: DataFrame) -> DataFrame:
    """Whole rows as ``_row`` beside their key, so that further columns may have any names."""
    plain = [c for c, t in docs.dtypes if "map<" not in t]
    return docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_held"), text_hash().alias("_key"),
                       F.xxhash64(*plain).alias("_order"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # numbered names: further columns may be named like the scores
    names = docs.columns
    plain = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    kept = quality.scored(plain, model, text_col=f"_c{names.index('text')}").where(F.col("p_good") >= 0.5)
    return kept.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.columns
    rows = jaccard.components_of(docs.select("doc_id", "text", text_hash().alias("_th")), k=5, percent=80, carry=("_th",))
    rows = rows.where(F.col("component_key").isNotNull())
    # one row of a group stays: smallest id, then smallest text hash
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th")).alias("m")
    kept = rows.groupBy("component_key").agg(best).select("m.doc_id", "m._th")
    copies = rows.groupBy("doc_id", "_th").agg(F.count("*").alias("n"))
    kept = kept.alias("l").join(copies.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
                                & (F.col("l._th") == F.col("r._th"))).select(
        F.col("l.doc_id").alias("_id"), F.col("l._th").alias("_th"), "n").checkpoint()
    held = wrapped(docs)
    same = F.col("_held").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_th"))
    single = held.join(kept.where("n = 1"), same).select("_row.*")
    # fully repeated rows: one of them stays
    order = Window.partitionBy("_id", "_key").orderBy("_order")
    several = (held.join(kept.where("n > 1"), same).withColumn("_rank", F.row_number().over(order))
               .where("_rank = 1").select("_row.*"))
    blank = docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z")).select(*columns)
    return single.unionByName(several).unionByName(blank)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slop=None)
    hit = found.select("doc_id", "_k").distinct()
    return wrapped(docs).join(hit.withColumnRenamed("doc_id", "_hit"), F.col("_held").eqNullSafe(F.col("_hit"))
                              & (F.col("_key") == F.col("_k")), "left_anti").select("_row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated ``copies`` times; the decision is a filter on source, hash and size."""
    columns = docs.columns
    return mixing.repeated(docs).select(*columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, SHARDS)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the session's checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{os.urandom(8).hex()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        schema = out.schema
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(schema).parquet(f"{base}/{name}")
    return docs
