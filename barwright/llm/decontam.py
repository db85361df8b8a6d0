"""Benchmark decontamination with a distributed positional inverted index.

A benchmark item is cut into windows of ten consecutive words (a shorter item is one window).
The index maps terms to postings (document, position); only terms that lead some window are
stored.  Steps:

1. count, over the whole corpus, the words that occur in the benchmark;
2. in each window take its rarest and second rarest place as first and second term;
3. store the postings of first and second terms (a written table), first-term postings with
   the neighbourhood that a window can reach;
4. offset-adjusted lists of the first terms give alignments; those stay candidates whose stored
   neighbourhood holds the whole window, or the second term within ``slop`` of its place;
5. the candidates' places of the second term are intersected with its list, so neither lists of
   frequent words nor alignments without a chance ever travel.  All of the window equal: phrase
   match; only the second term within ``slop`` of its place: proximity match.

Defined cases: null or empty texts have no words and no hits; items without words give no
window; repeated items and rows are kept (an item id counts once); an item without id is listed
as 'null'; an empty corpus or benchmark gives no hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.text import alnum_words, if_small, written
from barwright.session import ensure_checkpoint_dir

WINDOW = 10
#: most benchmark words, window leads or candidates whose table is broadcast, at 100 bytes each
BROADCAST_ROWS = 500_000


def weight(df: DataFrame, text: Column) -> int:
    """Rows of ``df``, or its bytes of ``text`` in hundreds if these are more."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return max(n, size // 100)


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """item (string), win (distinct word list), len.  One row per distinct window of an item."""
    w = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                         alnum_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("win"))
            .distinct().withColumn("len", F.size("win")))


def leads(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """Per distinct window: word and offset of its rarest (o1) and second rarest place (o2)."""
    places = (wins.select("win", "len").distinct()
              .select("win", "len", F.posexplode("win").alias("o", "word"))
              .join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    ranked = F.array_sort(F.collect_list(F.struct("n", "word", "o")))
    return places.groupBy("win", "len").agg(ranked.alias("r")).select(
        "win", "len", F.get("r", F.lit(0)).alias("a"), F.get("r", F.lit(1)).alias("b")
    ).select("win", "len", F.xxhash64("win").alias("wid"), F.col("a.word").alias("w1"), F.col("a.o").alias("o1"),
             F.col("a.n").alias("n1"), F.col("b.word").alias("w2"), F.col("b.o").alias("o2"))


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Document key (id and hash of the text: equal rows are alike in every result) and words."""
    return docs.select(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_k"),
                       alnum_words(F.col(text_col)).alias("_w"))


def corpus_counts(words: DataFrame, wins: DataFrame) -> tuple[DataFrame, int]:
    """(word, n over the corpus) of the benchmark's words, and how many such words there are."""
    vocab = wins.select(F.explode("win").alias("word")).distinct().checkpoint()
    size = weight(vocab, F.col("word"))
    return (words.select(F.explode("_w").alias("word")).join(if_small(vocab, size, BROADCAST_ROWS), "word")
            .groupBy("word").agg(F.count("*").alias("n"))), size


def index(words: DataFrame, lead: DataFrame, n_leads: int, id_col: str, reach: int = WINDOW - 1) -> DataFrame:
    """Positional postings of all first and second terms: term, document, position, whether it is
    a first or a second term, and for first ones the words within ``reach`` on both sides (``left``
    of them before the position)."""
    term = lambda c: F.explode(F.array(F.struct(F.col("w1").alias("word"), F.lit(True).alias("first")),
                                       F.struct(F.col("w2").alias("word"), F.lit(False).alias("first")))).alias(c)
    terms = (lead.select(term("t")).select("t.*").where(F.col("word").isNotNull())
             .groupBy("word").agg(F.max("first").alias("first"), F.max(~F.col("first")).alias("second")))
    near = F.when(F.col("first"), F.slice("_w", F.greatest(F.col("pos") - reach + 1, F.lit(1)),
                                          F.least(F.col("pos"), F.lit(reach)) + reach + 1))
    return written(words.select(id_col, "_k", "_w", F.posexplode("_w").alias("pos", "word"))
                   .join(if_small(terms, 2 * n_leads, BROADCAST_ROWS), "word")
                   .select("word", id_col, "_k", "pos", "first", "second", near.alias("near"),
                           F.least(F.col("pos"), F.lit(reach)).alias("left")), "postings")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int | None = 3) -> DataFrame:
    """_k, id, wid, start (word), len, kind ('phrase' or 'proximity'); ``slop`` None: phrases only."""
    ensure_checkpoint_dir(docs.sparkSession)
    words = _words(docs, id_col, text_col)
    wins = windows(benchmark, item_col, item_text, size)
    counts, _ = corpus_counts(words, wins)
    lead = leads(wins, counts).where(F.col("n1") > 0).checkpoint()
    n = weight(lead, F.array_join("win", " "))
    off = slop or 0
    posts = index(words, lead, n, id_col, size - 1 + off)
    ids = [id_col, "_k"]
    # offset-adjusted list of the first terms, and what their neighbourhood says of the window
    gap = F.col("left") + F.col("o2") - F.col("o1")
    low = F.greatest(gap - off, F.lit(0))
    one = (posts.where("first").join(if_small(lead.withColumnRenamed("w1", "word"), n, BROADCAST_ROWS), "word")
           .withColumn("start", F.col("pos") - F.col("o1"))
           .withColumn("same", F.slice("near", F.greatest(F.col("left") - F.col("o1") + 1, F.lit(1)), F.col("len"))
                       .eqNullSafe(F.col("win")) & (F.col("left") >= F.col("o1")))
           .withColumn("close", F.coalesce(F.array_contains(
               F.slice("near", low + 1, F.greatest(gap + off - low + 1, F.lit(0))), F.col("w2")), F.lit(False))))
    held = one.where("same" if slop is None else "same or close").select(
        *ids, "wid", "start", "len", "same", F.xxhash64("w2").alias("_w2"), (F.col("start") + F.col("o2")).alias("_at"),
        F.col("w2").isNull().alias("lone")).distinct().checkpoint()
    # second terms: their places around the candidates are met with the list
    shifts = F.sequence(F.lit(-off), F.lit(off))
    asked = held.where(~F.col("lone")).select(
        F.col(id_col).alias("_id"), F.col("_k").alias("_k2"), "wid", "start", "len", "same", "_w2", "_at",
        F.explode(shifts).alias("_shift")).withColumn("_at", F.col("_at") + F.col("_shift"))
    met = posts.where("second").select(*ids, F.xxhash64("word").alias("_word"), "pos").join(
        if_small(asked, asked.count(), BROADCAST_ROWS),
        F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_k2")) & (F.col("_word") == F.col("_w2"))
        & (F.col("pos") == F.col("_at")))
    kind = F.when(F.col("same") & F.max(F.col("_shift") == 0), "phrase").otherwise("proximity")
    both = met.groupBy(*ids, "wid", "start", "len", "same").agg(kind.alias("kind")).drop("same")
    lone = held.where("lone and same").select(*ids, "wid", "start", "len", F.lit("phrase").alias("kind"))
    return both.unionByName(lone)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, n_near
    (proximity matches), and the key ``_k``."""
    words = _words(docs, id_col, text_col)
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text, size).checkpoint()
    ids = [id_col, "_k"]
    phrase = found.where(F.col("kind") == "phrase")
    # words hit: length of the union of the occurrences
    by = Window.partitionBy(*ids).orderBy("start", "len")
    prev = F.max(F.col("start") + F.col("len")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("start") + F.col("len") - F.greatest(F.col("start"), F.coalesce(prev, F.lit(0))), F.lit(0))
    hit = phrase.withColumn("fresh", fresh).groupBy(*ids).agg(F.sum("fresh").alias("n_hit"))
    items = windows(benchmark, item_col, item_text, size).select("item", F.xxhash64("win").alias("wid"))
    listed = (phrase.select(*ids, "wid").distinct().join(items, "wid").groupBy(*ids)
              .agg(F.array_sort(F.collect_set("item")).alias("items")))
    near = found.where(F.col("kind") == "proximity").groupBy(*ids).agg(F.count("*").alias("n_near"))
    join = lambda l, r: l.join(r.withColumnRenamed(id_col, "_id").withColumnRenamed("_k", "_k2"),
                               F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_k2")),
                               "left").drop("_id", "_k2")
    out = join(join(join(words.select(*ids, F.size("_w").cast("long").alias("n_words")), hit), listed), near)
    return out.select(id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "_k")
