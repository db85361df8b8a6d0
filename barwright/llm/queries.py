"""Registered queries of the operators: thin digests over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from barwright.llm import (chat, decontam, divergence, htmltext, jaccard, licenses, mixing, periodic, quality, secrets, sharding,
                           simhash, sql, tokens)
from barwright.llm.text import WHITE, written
from barwright.session import ensure_checkpoint_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    raw = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return sharding.shard(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_licenses(spark, sf_dir):
    return licenses.labelled(table(spark, sf_dir, "documents"))


def op3_jaccard(spark, sf_dir):
    return jaccard.components_of(table(spark, sf_dir, "documents"), k=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def op3_jaccard_links(spark, sf_dir):
    # the whole join: one row per link of two classes, with the counts of both
    links, counts = jaccard.links_of(table(spark, sf_dir, "documents"), k=3, percent=90)
    names = ("n_docs", "n_links", "n_linked_docs")
    of = lambda c: counts.select(F.col("class_key").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in names))
    return links.join(of("a"), "a").join(of("b"), "b")


def op4_htmltext(spark, sf_dir):
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op5_tokens(spark, sf_dir):
    return tokens.counted(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_simhash(spark, sf_dir):
    # the fingerprints are read twice by the search: written once
    ensure_checkpoint_dir(spark)
    return simhash.searched(written(simhash.compared(table(spark, sf_dir, "documents")), "prints"), radius=simhash.NEAR)


def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_secrets(spark, sf_dir):
    # two runs of the ledger: an earlier version of the table (even ids), then the whole of it, of
    # which only blobs that the first run has not seen are scanned
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    ledger = spark.createDataFrame([], secrets.LEDGER)
    for version in (docs.where("doc_id % 2 = 0"), docs):
        ledger = written(secrets.update(version, ledger), "ledger")
    return secrets.report(docs, ledger).drop("blob")


def op9_decontam(spark, sf_dir):
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_k")


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, keep_all=False).withColumn("keep", F.col("p_good") >= 0.5)


def op11_divergence(spark, sf_dir):
    return divergence.divergences(table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the text of one document in ten, by the checksum of its id,
    periodic from a word on; a null id is left alone."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", WHITE), "")
    g, n = F.expr("h div 10"), F.size("w")
    docs = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    docs = docs.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    docs = docs.withColumn("p", F.expr("cast(1 + (size(w) - a) div (3 + (h div 10) % 8) as int)"))
    again = F.expr("transform(sequence(a, size(w) - 1), i -> w[a + (i - a) % p])")
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), again)
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark, sf_dir):
    found = periodic.collapsed(planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws("", r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = lambda c: F.col(f"best.{c}")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best("start").alias("start"), best("length").alias("length"),
        best("period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: a conversation whose texts hold control strings and escape signs
TRAP = r"\### Assistant: </turn> ok"


def op13_chat(spark, sf_dir):
    more = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.formatted(chat.segments(rows)))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_licenses, op3_jaccard, op3_jaccard_links, op4_htmltext, op5_tokens, op6_simhash,
                                   op7_mixing, op8_secrets, op9_decontam, op10_quality, op11_divergence, op12_periodic,
                                   op13_chat)}

QUERIES["pipeline"] = corpus_pipeline.run
#: SQL of the queries that SQL can express over whole tables
ORACLES: dict[str, str] = dict(sql.ORACLES)
