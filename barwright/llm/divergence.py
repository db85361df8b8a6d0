"""Source divergence audit: how far the term shares of a source are from those of the other
sources and of all texts of its language.

Terms are runs of letters (ASCII letters lower-cased) and of non-ASCII characters.  A task lowers
its texts with ``ascii_lower``, splits them with ``split_pattern_regex``, encodes the terms with
``dictionary_encode`` and counts them with hash ``group_by``, all on Arrow columns inside
``mapInArrow``; what leaves it are partial counts.  Spark merges them with one shuffle by language
and term into columnar shards: one row per term of a language with the counts of its sources.  A
second ``mapInArrow`` over the shards sums the differences of every pair of sources on matrices of
a bounded number of terms and keeps the leading terms per source.

The share of a term in a group is ``1 + floor(10**9 * (count + 5) / (N + 5 * V))``: V kept terms
(those in at least ``least_docs`` documents of the language), N the group's count over them.  All
numbers are exact integers.

Bounds: a task holds the counts of ``SLICE`` bytes of text and at most ``HELD`` merged rows; a text
beyond ``SLICE`` goes in pieces cut between terms; a shard matrix has ``CELLS`` cells.  Totals are
sent to the tasks with one row per group, of which the result has the square within a language.

Defined cases: null text, language or source is the empty string; an empty text has no terms but
its group counts; a language without kept terms gives pairs of value 0; every row is a document of
its own, repeated rows too; ties of a ranking go by the UTF-8 bytes of the item; further columns
are ignored; an empty table gives an empty result."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.text import written
from barwright.session import ensure_checkpoint_dir

LEAST_DOCS, TOP = 30, 50
PRIOR = 5
#: between terms: every ASCII character but letters
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_CUT = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
#: bytes of text counted at once, rows of counts held by a task, cells of a shard matrix
SLICE, HELD, CELLS = 4 << 20, 500_000, 2_000_000

PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
RESULT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()),
                    ("item", pa.string()), ("value", pa.int64())])


def cut(raw: bytes) -> Iterator[str]:
    """Pieces of a text of about ``SLICE`` bytes, cut after a character that is in no term."""
    at = 0
    while at < len(raw):
        m = _CUT.search(raw, min(at + SLICE, len(raw)))
        end = m.end() if m else len(raw)
        yield raw[at:end].decode("utf-8", "replace")
        at = end


def doc_terms(texts: pa.Array) -> pa.Table:
    """(doc, term, n) of texts, doc being their number."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    terms = parts.flatten().dictionary_encode()
    counts = pa.table({"doc": pc.list_parent_indices(parts), "code": terms.indices}).group_by(["doc", "code"]).aggregate([([], "count_all")])
    blank = pc.index(terms.dictionary, "").as_py()
    counts = counts.filter(pc.not_equal(counts["code"], blank))
    return pa.table({"doc": counts["doc"], "term": terms.dictionary.take(counts["code"].combine_chunks()), "n": counts["count_all"]})


def merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([t["lang"], t["source"], t["term"], t["n_sum"], t["docs_sum"]], schema=PARTIAL)


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``SLICE`` bytes; a larger row is a range of its own."""
    at, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and total + n > SLICE:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def batch_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> Iterator[pa.Table]:
    """Partial counts of a batch; a row with a null term says that its group occurs."""
    groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"]).aggregate([])
    zero = pa.array(np.zeros(len(groups), np.int64))
    yield pa.table([groups["lang"], groups["source"], pa.nulls(len(groups), pa.string()), zero, zero], schema=PARTIAL)
    for a, b in slices(pc.binary_length(text).to_numpy(zero_copy_only=False)):
        part = text.slice(a, b - a)
        if b - a == 1 and len(raw := part[0].as_py().encode("utf-8", "replace")) > SLICE:
            found = pa.concat_tables([doc_terms(pa.array([p], pa.string())) for p in cut(raw)]).group_by("term").aggregate([("n", "sum")])
            doc, n = pa.array(np.zeros(len(found), np.int32)), found["n_sum"]
        else:
            found = doc_terms(part)
            doc, n = found["doc"], found["n"]
        yield pa.table([lang.slice(a, b - a).take(doc), source.slice(a, b - a).take(doc), found["term"], n,
                        pa.array(np.ones(len(found), np.int64))], schema=PARTIAL)


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for b in batches:
        for t in batch_counts(*b.columns):
            held.append(t)
            rows += len(t)
            if rows > HELD:
                held = [merged(held)]
                rows = len(held[0])
                if 2 * rows > HELD:  # mostly rare terms: nothing gained by holding them longer
                    yield from held[0].to_batches(max_chunksize=20_000)
                    held, rows = [], 0
    if held:
        yield from merged(held).to_batches(max_chunksize=20_000)


def shards(docs: DataFrame, least_docs: int = LEAST_DOCS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, term, found: array of (source, n)) of the kept terms, and per language one row with
    a null term that has all of its sources."""
    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = src.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    return (counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("found"), F.sum("docs").alias("docs"))
            .where(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + PRIOR) / total), three digits at a time so that nothing overflows
    for totals below 9 * 10**15."""
    rest, out = count + PRIOR, np.zeros(np.broadcast_shapes(count.shape, np.shape(total)), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


class Lang:
    """Running sums of one language over the terms of a shard."""

    def __init__(self, sources: list[str], totals: np.ndarray, kept: int, top: int):
        self.sources, self.top = sources, top
        self.values = pa.array(sources, pa.string())
        self.group, self.all = totals + PRIOR * kept, np.int64(totals.sum() + PRIOR * kept)
        self.pair = np.zeros((len(sources), len(sources)), np.int64)
        self.lead: list[list[tuple[int, bytes]]] = [[] for _ in sources]

    def add(self, terms: pa.Array, found: pa.Array) -> None:
        rows = max(1, CELLS // len(self.sources))
        for at in range(0, len(terms), rows):
            some = found.slice(at, rows)
            pairs = some.flatten()
            count = np.zeros((len(some), len(self.sources)), np.int64)
            count[pc.list_parent_indices(some).to_numpy(), pc.index_in(pairs.field("source"), value_set=self.values).to_numpy()] = \
                pairs.field("n").to_numpy()
            p, q = shares(count, self.group), shares(count.sum(axis=1), self.all)
            names = terms.slice(at, rows)
            for g in range(len(self.sources)):
                self.pair[g] += np.abs(p - p[:, g:g + 1]).sum(axis=0)
                over = p[:, g] - q
                at_g = np.flatnonzero((count[:, g] > 0) & (over > 0))
                if len(at_g) > self.top:  # ties of the last place stay
                    at_g = at_g[over[at_g] >= np.partition(over[at_g], -self.top)[-self.top]]
                new = zip(over[at_g].tolist(), (t.encode() for t in names.take(pa.array(at_g)).to_pylist()), strict=True)
                self.lead[g] = sorted([*self.lead[g], *new], key=lambda x: (-x[0], x[1]))[:self.top]

    def rows(self, lang: str) -> Iterator[tuple]:
        for g, name in enumerate(self.sources):
            for h, other in enumerate(self.sources):
                if g != h:
                    yield lang, name, "pair", other, int(self.pair[g, h])
            for value, term in self.lead[g]:
                yield lang, name, "term", term.decode(), value


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang: str = "lang", source: str = "source",
                text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank).  ``pair``: sum over the kept terms of the
    difference of shares to another source of the language; ``term``: the ``top`` terms whose share
    in the source is most above their share in the language."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    table = written(shards(docs, least_docs, lang, source, text), "shards")
    groups = table.select("lang", F.explode("found").alias("f")).groupBy("lang", F.col("f.source").alias("source")).agg(F.sum("f.n").alias("n"))
    kept = dict(table.groupBy("lang").agg(F.count("term")).collect())
    # one row per (language, source); the result has the square of it within a language
    totals: dict[str, list[tuple[str, int]]] = {}
    for r in groups.orderBy("lang", "source").collect():
        totals.setdefault(r["lang"], []).append((r["source"], r["n"]))
    known = spark.sparkContext.broadcast((totals, kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, kept = known.value
        langs: dict[str, Lang] = {}
        for b in batches:
            codes = b.column(0).dictionary_encode()
            for code, name in enumerate(codes.dictionary.to_pylist()):
                if name not in langs:
                    langs[name] = Lang([s for s, _ in totals[name]], np.array([n for _, n in totals[name]], np.int64), kept[name], top)
                own = b.filter(pc.equal(codes.indices, code))
                langs[name].add(own.column(1), own.column(2))
        for name, x in langs.items():
            rows = list(x.rows(name))
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + 10_000], strict=True), RESULT, strict=True)], schema=RESULT)
    out = table.where("term IS NOT NULL").mapInArrow(run, "lang string, source string, part string, item string, value long")
    # pairs of languages without kept terms
    one, two = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    none = one.join(two, "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return (out.unionByName(none).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top)))
