"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id and text.  Tokens are summed by source and hash
bucket; a running sum over the 4,096 buckets of a source finds the bucket in which its budget
ends, and only that bucket is split again by the next 12 bits, until it holds one hash value.
The result per source is a threshold: documents at or below it are in the mix; two further
passes fill what the boundary document left open with documents small enough for it.  First
thresholds of growing budgets are nested, nothing is sorted by hash, and a rerun decides alike.

Defined cases: null text has size 0; null source is a source of its own (last); a source of
size 0 has target 0 and its documents get 0 copies; a document of size 0 goes with the whole
passes of its source only (0 to 3 copies), as it fills nothing; fully repeated rows (same id, same text)
share one hash and one decision; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.text import if_small, n_white_words
from barwright.session import ensure_checkpoint_dir

BITS, STEP = 60, 12
#: searches per source: the first over all documents, the others over those small enough for the
#: words that the boundary document left open
PASSES = 3
#: most sources whose table is broadcast (about 100 bytes each)
BROADCAST_SOURCES = 50_000


def doc_hash(doc_id: Column, text: Column, seed: int = 0) -> Column:
    """60-bit hash of a document's id and text."""
    d = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                       F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(d, 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``sizes`` (skey, source, s long) -> the same with ``target`` double.

    Sources in code-point order (null last) take the weights in turn and share the sum of all
    sizes; a target stops at ``most`` times its source's size and the excess is shared again.
    Closed form: in the order of size by weight the capped sources are a prefix, so running
    sums over the table of sources (one row each) settle it in one pass."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    order = Window.orderBy(F.col("s") / F.col("w"), F.col("skey"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = sizes.withColumn("w", w.cast("long"))
    t = (t.withColumn("left", F.sum("s").over(every) - most * F.coalesce(F.sum("s").over(before), F.lit(0)))
          .withColumn("wleft", F.sum("w").over(after))
          .withColumn("share", F.col("left").cast("double") / F.col("wleft").cast("double"))
          .withColumn("capped", F.col("share") * F.col("w") > most * F.col("s")))
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("s") / F.col("w"), "skey", "left", "wleft"))).over(every)
    return t.withColumn("f", first).withColumn(
        "target", F.when(F.col("capped"), (most * F.col("s")).cast("double"))
        .otherwise((F.col("w") * F.col("f.left")).cast("double") / F.col("f.wleft").cast("double"))
    ).select("skey", "source", "s", "target")


def one_pass(docs: DataFrame, state: DataFrame, n_sources: int) -> DataFrame:
    """``state`` (skey, rem, floor, cap) with ``cut``: the largest hash up to which the documents
    above ``floor`` of at most ``cap`` words fit into the budget ``rem``, and what then remains."""
    state = state.withColumn("prefix", F.lit(0).cast("long")).withColumn("cut", F.lit(None).cast("long")).checkpoint()
    for level in range(BITS // STEP):
        open_ = state.where(F.col("cut").isNull())
        if open_.isEmpty():
            break
        here, deep = BITS - STEP * level, BITS - STEP * (level + 1)
        # only documents of the boundary buckets are summed again
        hist = (docs.join(if_small(open_.select("skey", "prefix", "floor", "cap"), n_sources, BROADCAST_SOURCES), "skey")
                .where((F.shiftright("h", here) == F.col("prefix")) & (F.col("h") > F.col("floor"))
                       & (F.col("size") <= F.col("cap")))
                .groupBy("skey", F.shiftright("h", deep).alias("b"))
                .agg(F.sum("size").alias("n"), F.min("h").alias("h0"), F.max("h").alias("h1")))
        cum = Window.partitionBy("skey").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        edge = (hist.withColumn("cum", F.sum("n").over(cum))
                .join(if_small(open_.select("skey", "rem"), n_sources, BROADCAST_SOURCES), "skey")
                .where(F.col("cum") > F.col("rem"))
                .groupBy("skey").agg(F.min(F.struct("b", "n", "cum", "h0", "h1")).alias("e"))
                .select("skey", "e.*", F.lit(True).alias("met")))
        all_ = hist.groupBy("skey").agg(F.sum("n").alias("every"), F.max("h1").alias("top"))
        found = all_.join(edge, "skey", "left")
        # the boundary bucket of one hash value ends the search; no boundary: all of it fits
        inside = F.col("rem") - (F.col("cum") - F.col("n"))
        state = (state.join(found, "skey", "left").select(
            "skey", "floor", "cap",
            F.when(F.col("cut").isNotNull() | F.col("every").isNull(), F.col("rem"))
            .when(F.col("met"), inside).otherwise(F.col("rem") - F.col("every")).alias("rem"),
            F.when(F.col("met"), F.col("b")).otherwise(F.col("prefix")).alias("prefix"),
            F.when(F.col("cut").isNotNull(), F.col("cut")).when(F.col("every").isNull(), F.col("floor"))
            .when(F.col("met").isNull(), F.col("top"))
            .when(F.col("h0") == F.col("h1"), F.col("h0") - 1).alias("cut")).checkpoint())
    return state


def thresholds(docs: DataFrame, sources: DataFrame, n_sources: int, passes: int = PASSES) -> DataFrame:
    """Per source: ``copies`` whole passes, and rules (cut, cap): a document whose hash is at most
    ``cut`` and whose size is at most ``cap`` for one of them is taken once more."""
    base = sources.select("skey", "s", "target", F.when(F.col("s") > 0, F.floor(F.col("target") / F.col("s")))
                          .otherwise(0).cast("long").alias("copies"))
    state = base.select("skey", F.when(F.col("s") > 0, F.col("target") - F.col("copies") * F.col("s")).otherwise(0.0)
                        .alias("rem"), F.lit(-1).cast("long").alias("floor"))
    out = base
    for i in range(passes):
        # later passes fill what the boundary document left with documents that fit
        state = state.withColumn("cap", F.lit(1 << 62) if i == 0 else F.floor("rem").cast("long"))
        state = one_pass(docs, state, n_sources)
        out = out.join(state.select("skey", F.col("cut").alias(f"cut{i}"), F.col("cap").alias(f"cap{i}")), "skey")
        state = state.select("skey", "rem", F.col("cut").alias("floor"))
    return out.checkpoint()


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> dict[str, Column]:
    src = F.col(source_col).cast("string")
    return {"size": n_white_words(F.col(text_col)), "h": doc_hash(F.col(id_col), F.col(text_col), seed),
            "skey": F.when(src.isNull(), "n").otherwise(F.concat(F.lit("v"), src))}


def decided(slim: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, int]:
    """Per source (skey): s, target, copies and rules; and the number of sources."""
    sizes = slim.groupBy("skey").agg(F.sum("size").alias("s")).withColumn(
        "source", F.when(F.col("skey") != "n", F.substring("skey", 2, 1 << 30)))
    sources = targets(sizes, weights, most).checkpoint()
    n = sources.count()
    return thresholds(slim, sources, n), n


def copies_of() -> Column:
    """Copies of a document: whole passes, and one more by any rule of its source."""
    once = F.lit(False)
    for i in range(PASSES):
        once = once | ((F.col("h") <= F.col(f"cut{i}")) & (F.col("size") <= F.col(f"cap{i}")))
    return F.col("copies") + (once & (F.col("size") > 0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 0) -> DataFrame:
    """One row per document: id, size, source_size, target (its source's), copies, taken."""
    ensure_checkpoint_dir(docs.sparkSession)
    keys = _keyed(docs, id_col, text_col, source_col, seed)
    slim = docs.select(F.col(id_col).alias("_id"), *(c.alias(k) for k, c in keys.items())).checkpoint()
    cuts, n = decided(slim, weights, most)
    return (slim.join(if_small(cuts, n, BROADCAST_SOURCES), "skey").withColumn("_n", copies_of())
            .select(F.col("_id").alias(id_col), "size", F.col("s").alias("source_size"), "target",
                    F.col("_n").alias("copies"), (F.col("size") * F.col("_n")).alias("taken")))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` (all columns) as often as the mix takes them: each row decides by its
    own hash and size, so texts are not shuffled."""
    ensure_checkpoint_dir(docs.sparkSession)
    columns = docs.columns
    keys = _keyed(docs, id_col, text_col, source_col, seed)
    slim = docs.select(*(c.alias(k) for k, c in keys.items())).checkpoint()
    cuts, n = decided(slim, weights, most)
    whole = docs.select(F.struct(*columns).alias("_row"), *(c.alias(k) for k, c in keys.items()))
    return (whole.join(if_small(cuts, n, BROADCAST_SOURCES), "skey").withColumn("_n", copies_of())
            .where(F.col("_n") > 0)
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy")).select("_row.*"))
