"""Licence scan by diagonal voting.

All rolling two-word grams of every text are hashed and joined to the positions of the same
gram in the templates.  A match at word p of the document and word q of a template votes for
the diagonal p - q.  Votes are aggregated by diagonal; a diagonal with every gram of a phrase is
an exact occurrence.  For longer templates neighbouring diagonals are merged (a few inserted or
missing words shift the diagonal) and the matches of a merged run are verified from every start: a
span holds enough distinct template grams within a bounded length.  Repeats of single grams may
make a run as long as the text; they hide no span, as the bound is the span's and not the run's.
Overlapping shortest spans are joined.

The template table is a constant of this module, so broadcasting it is bounded.  A gram is
moved only if its hash is one of the template's; the words themselves are compared in the join.

Defined cases: null or empty text has no words, no labels and score 0; repeated rows are
scanned as rows of their own; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.text import alnum_words
from barwright.session import ensure_checkpoint_dir

K = 2
#: phrases whose every exact place counts (fixed values): phrase, label
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: longer passages found with gaps: public notices of the licences, by label
PASSAGES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the mozilla public license version 2 0", "mpl-2.0"),
    ("licensed under a creative commons attribution license", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-text"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu",
     "gpl-text"),
)
#: neighbouring diagonals at most this far apart belong together
GAP = 3
#: share of a passage's grams that a span must hold
COVER = 0.8


def templates(spark, passages=PASSAGES) -> DataFrame:
    """One row per template gram: template id, label, kind, number of grams, position, both words."""
    rows = []
    for t, (text, label) in enumerate([*PHRASES, *passages]):
        words = text.split()
        for q in range(len(words) - K + 1):
            rows.append((t, label, t < len(PHRASES), len(words) - K + 1, q, words[q], words[q + 1]))
    return spark.createDataFrame(rows, "t int, label string, exact boolean, grams int, q int, w1 string, w2 string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passages=PASSAGES) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).  documents: _row, id, n_words, one row per input row.  spans: _row,
    label, exact, first word, last word, score (share of the template's grams)."""
    spark = docs.sparkSession
    table = templates(spark, passages)
    ensure_checkpoint_dir(spark)
    # hashes of all rolling grams; only places whose hash is a template's are moved
    known = [r[0] for r in table.select(F.xxhash64("w1", "w2")).distinct().collect()]
    words = docs.select(F.col(id_col), alnum_words(F.col(text_col)).alias("_w"))
    grams = F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    places = F.array_remove(F.transform(grams, lambda g, i: F.when(g.isin(known), i).otherwise(-1)), -1)
    held = words.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.size("_w").cast("long").alias("n_words"),
        F.transform(places, lambda p: F.struct(p.alias("p"), F.get("_w", p).alias("w1"), F.get("_w", p + 1).alias("w2")))
        .alias("at")).checkpoint()
    base = held.drop("at")
    hits = (held.select("_row", F.explode("at").alias("at")).select("_row", "at.*")
            .join(F.broadcast(table), ["w1", "w2"])
            .select("_row", "t", "label", "exact", "grams", "q", "p", (F.col("p") - F.col("q")).alias("d")))
    votes = hits.groupBy("_row", "t", "label", "exact", "grams", "d").agg(
        F.count("*").alias("n"), F.collect_list(F.struct("p", "q")).alias("at"))
    # exact phrases: every gram on one diagonal
    exact = votes.where(F.col("exact") & (F.col("n") == F.col("grams"))).select(
        "_row", "label", "exact", F.col("d").cast("long").alias("first"),
        (F.col("d") + F.col("grams")).cast("long").alias("last"), F.lit(1.0).alias("score"))
    # passages: runs of diagonals with small steps, cut where they lie too far apart
    by = Window.partitionBy("_row", "t").orderBy("d")
    step = F.when(F.col("d") - F.lag("d").over(by) <= GAP, 0).otherwise(1)
    runs = (votes.where(~F.col("exact")).withColumn("run", F.sum(step).over(by))
            .select("_row", "t", "label", "exact", "grams", "run", F.explode("at").alias("at"))
            .select("_row", "t", "label", "exact", "grams", "run", "at.*"))
    spans = shortest(runs, max((len(text.split()) for text, _ in passages), default=K))
    return base, exact.unionByName(spans.select(*exact.columns))


def shortest(runs: DataFrame, longest: int) -> DataFrame:
    """Spans of the matches (p, q) of every run: from each match, those of the next
    2 * (grams + K) words; with enough distinct grams, the span ends where the share is reached.
    Joined spans start with the first and end with the last of their shortest ones; the score is
    the best share of a start.  ``longest``: words of the longest passage, which bounds the frame."""
    group = ("_row", "t", "run")
    reach = 2 * (F.col("grams") + K) - K
    ahead = Window.partitionBy(*group).orderBy("p").rangeBetween(0, 2 * (longest + 1) - K)
    need = F.ceil(F.col("grams") * COVER - 1e-9).cast("int")
    near = F.filter(F.collect_list(F.struct("p", "q")).over(ahead), lambda m: m["p"] <= F.col("p") + reach)
    starts = (runs.withColumn("w", F.array_sort(near)).withColumn("qs", F.array_distinct(F.col("w.q")))
              .withColumn("got", F.size("qs")).where(F.col("got") >= need)
              .withColumn("e", F.get(F.filter("w", lambda m: m["q"] == F.get("qs", need - 1)), F.lit(0))["p"])
              .drop("w", "qs"))
    by = Window.partitionBy(*group).orderBy("p", "q")
    # no match after the start of a shortest span reaches the share at the same place
    least = F.coalesce(F.lead("e").over(by) > F.col("e"), F.lit(True))
    fresh = F.when(F.col("p") <= F.lag("e").over(by) + K - 1, 0).otherwise(1)
    return (starts.withColumn("least", least).withColumn("span", F.sum(fresh).over(by))
            .groupBy(*group, "label", "exact", "grams", "span")
            .agg(F.min(F.when(F.col("least"), F.col("p"))).cast("long").alias("first"),
                 (F.max("e") + K - 1).cast("long").alias("last"), (F.max("got") / F.col("grams")).alias("score")))


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base, spans = scan(docs, id_col, text_col)
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    found = spans.groupBy("_row").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).alias("last_word"),
        joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"), F.max("score").alias("score"))
    return base.join(found, "_row", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
