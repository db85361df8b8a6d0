"""SimHash fingerprints and the search for near ones through permuted block tables.

Terms are the three-word shingles and the single words of the lower-cased text; a shingle
weighs 1 per occurrence and a word ``WORD_WEIGHT``.  Every term's 128-bit hash votes on each bit
with its weight, positive for a set bit and negative for a clear one; the sign of the sum is the
fingerprint's bit.  The share of equal bits estimates 1 - angle / pi of the term vectors.

Search: a fingerprint is cut into eight blocks of 16 bits, each with a number of bits it may
differ in; the numbers plus one add up to the radius plus one, so within the radius some block
keeps to its number (pigeonhole).  A fingerprint stands once in each block's table and is asked
for under every key within the block's number of bits (for 20 bits: 5 blocks of 2 and 3 of 1,
736 keys).  A pair is taken only from the first block that keeps to its number, and verified by
its distance, so nothing within the radius is lost or repeated.

Near copies (other words, Jaccard of 5-word shingles 0.8 or more) differ in far more bits than a
few: of the 48 such pairs at sf0.1 none lies within 6 bits and 47 within ``NEAR`` = 20 (medians
14, 13.5 and 11.5 bits at 0.80-0.85, 0.85-0.90 and 0.90-0.95; the one left out has 25).

A match is a fingerprint, with the number and the smallest id of its documents, so copies are
found (at distance 0) and counted without being paired with each other.

Defined cases: null or empty text has no terms and the fingerprint of all zero bits; equal texts
have equal fingerprints; a text of fewer than three words is one shingle; an empty table gives
an empty result."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.hashing import U64, mixed, shingle_hashes, word_hashes
from barwright.llm.text import partitions, written

WORD_WEIGHT, SHINGLE = 0.25, 3
BITS, BLOCKS, RADIUS = 128, 8, 6
#: radius of near copies, from the measured distances above
NEAR = 20
CHUNK = 1 << 14
#: characters of a text that order rows of one id; sampled keys per bucket
PREFIX, SAMPLE = 256, 20


def votes(h: np.ndarray, weight: float) -> np.ndarray:
    """Signed votes of term hashes on 128 bits, in chunks of bounded size."""
    out = np.zeros(BITS)
    for at in range(0, len(h), CHUNK):
        part = h[at:at + CHUNK]
        both = np.stack((mixed(part), mixed(part ^ U64(0xD1B54A32D192ED03))), axis=1)
        set_bits = np.unpackbits(both.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
        out += weight * (2 * set_bits - len(part))
    return out


def fingerprint(text: str) -> np.ndarray:
    """Boolean bits of a text's fingerprint."""
    w = word_hashes(text)
    if not len(w):
        return np.zeros(BITS, bool)
    return votes(shingle_hashes(w, SHINGLE), 1.0) + votes(w, WORD_WEIGHT) > 0


def as_hex(bits: np.ndarray) -> str:
    return np.packbits(bits).tobytes().hex()


def edited(text: str, nxt: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``nxt``."""
    half = len(text) // 2
    return text[:len(text) - half] + nxt[:half]


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_b, _halo, _id, _t, _n): documents in buckets of ascending id, then text (its first
    ``PREFIX`` characters and its hash), each bucket with the row that follows its last one (the
    first row of the next bucket; after the last bucket, of the first).  Bounds are keys from an
    even sample of the distinct keys, so rows of one id spread over buckets; equal rows of a batch
    go as one with their number.  Each text is moved once, and the halo's."""
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    nan = F.isnan("_id") if src.schema["_id"].dataType.simpleString() in ("float", "double") else F.lit(False)
    src = src.select("_id", F.when(F.col("_id").isNull(), 0).when(nan, 2).otherwise(1).alias("_l"),
                     F.substring("_t", 1, PREFIX).alias("_p"), F.xxhash64("_t").alias("_h"), "_t")
    names = ["_l", "_id", "_p", "_h"]
    # a row's place: ids compare as themselves, null and NaN by their level alone
    place = lambda l, i, p, h: (l, i if l == 1 else 0, p, h)
    keys = written(src.select(*names).distinct(), "keys")
    share = (SAMPLE * n << 30) // max(1, keys.count())
    # about SAMPLE keys a bucket, however many tasks there are
    sample = sorted(place(*r) for r in keys.where(F.pmod(F.xxhash64("_id", "_h"), F.lit(1 << 30)) < share).collect())
    bounds = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []

    @F.pandas_udf("int")
    def bucket(l: pd.Series, i: pd.Series, p: pd.Series, h: pd.Series) -> pd.Series:  # noqa: E741
        return pd.Series([bisect_right(bounds, place(*r)) for r in zip(l, i, p, h)], dtype="int32")

    # ids keep their type on the way: a nullable integer column would come as doubles
    exact = F.coalesce("_id", F.lit(0).cast(src.schema["_id"].dataType))
    at = bucket("_l", exact, "_p", "_h")
    first = F.min(F.struct("_l", exact.alias("_id"), "_p", "_h"))
    lows = keys.groupBy(at.alias("b")).agg(first.alias("low")).orderBy("b").collect()  # one row a bucket
    before = {place(*r["low"]): lows[i - 1]["b"] for i, r in enumerate(lows)}
    kind = src.schema["_id"].dataType.simpleString()
    out = ["_b", "_halo", "_id", "_l", "_p", "_h", "_t", "_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {}
            for i, r in enumerate(zip(*(b.column(x).to_pylist() for x in (1, 0, 2, 3)))):
                key = place(*r)
                if key in rows and b.column(4)[rows[key][0]] == b.column(4)[i]:
                    rows[key][1] += 1
                else:  # texts of one hash that differ stay rows of their own
                    rows[key if key not in rows else (*key, i)] = [i, 1]
            take, to, halo, count = [], [], [], []
            for key, (i, many) in rows.items():
                key = key[:4]
                for where, is_halo in ((bisect_right(bounds, key), False), (before.get(key), True)):
                    if where is not None:
                        take.append(i)
                        to.append(where)
                        halo.append(is_halo)
                        count.append(many)
            got = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(halo, pa.bool_()), *got.columns,
                                              pa.array(count, pa.int64())], out)
    placed = src.mapInArrow(run, f"_b int, _halo boolean, _id {kind}, _l int, _p string, _h long, _t string, _n long")
    return (placed.repartition(partitions(spark), "_b")
            .sortWithinPartitions("_b", "_halo", "_l", F.col("_id").asc_nulls_first(), "_p", "_h", "_t")
            .select("_b", "_halo", "_id", "_t", "_n"))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (share of equal bits)."""
    rows = in_order(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # held: bucket, id, text, bits and number of the row that awaits its next

        def against(text: str, bits: np.ndarray) -> tuple:
            """Columns of the held row with ``text`` as its next."""
            _, _, mine, my_bits, _ = held
            ed = edited(mine, text)
            ed_bits = fingerprint(ed)
            return (len(mine), hashlib.sha256(ed.encode("utf-8", "surrogatepass")).hexdigest(), as_hex(my_bits),
                    as_hex(ed_bits), float((my_bits == ed_bits).mean()), float((my_bits == bits).mean()))

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                ids, out = [], [[] for _ in range(6)]
                for i, (bucket, halo, text, n) in enumerate(zip(*(b.column(x).to_pylist() for x in (0, 1, 3, 4)))):
                    if halo and (held is None or held[0] != bucket):
                        continue  # only the first of equal halo rows follows
                    bits = fingerprint(text)
                    if held is not None and held[0] == bucket:
                        # equal rows follow each other, the last one is followed by this row
                        for many, nxt in ((held[4] - 1, held[2:4]), (1, (text, bits))):
                            if many:
                                ids += [held[1]] * many
                                for col, v in zip(out, against(*nxt)):
                                    col += [v] * many
                    held = None if halo else (bucket, b.column(2)[i].as_py(), text, bits, n)
                if ids:
                    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(2).type),
                                                      *(pa.array(c, t) for c, t in zip(out, types))], names)
    schema = f"_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def allowed(radius: int) -> list[int]:
    """Bits each block may differ in: the numbers plus one add up to ``radius`` + 1 (-1: the block
    is not needed)."""
    if radius < 0:
        raise ValueError(f"radius {radius} is negative")
    return [(radius + 1) // BLOCKS - 1 + (i < (radius + 1) % BLOCKS) for i in range(BLOCKS)]


def halves(fps: DataFrame) -> DataFrame:
    """(hi, lo): the distinct fingerprints as two 64-bit numbers."""
    half = lambda at: F.conv(F.substring("fingerprint", at, 16), 16, -10).cast("long")
    return fps.select(half(1).alias("hi"), half(17).alias("lo")).distinct()


def block(i: int) -> Column:
    return F.shiftrightunsigned("hi" if i < BLOCKS // 2 else "lo", 48 - 16 * (i % (BLOCKS // 2))).bitwiseAND(0xFFFF)


def tables(fps: DataFrame, radius: int) -> DataFrame:
    """(hi, lo, key): one row per fingerprint and block that is needed; key: block number and bits."""
    keys = [block(i) + (i << 16) for i, n in enumerate(allowed(radius)) if n >= 0]
    return fps.select("hi", "lo", F.explode(F.array(*keys)).alias("key"))


def asked(fps: DataFrame, radius: int) -> DataFrame:
    """``tables`` with every key within the block's allowed number of bits."""
    flips = [(i << 16, sum(1 << x for x in c)) for i, n in enumerate(allowed(radius))
             for k in range(n + 1) for c in combinations(range(16), k)]
    flip = fps.sparkSession.createDataFrame(flips, "of long, bits long")
    t = tables(fps, radius)
    return t.join(F.broadcast(flip), t["key"].bitwiseAND(~0xFFFF) == F.col("of")).select(
        "hi", "lo", F.col("key").bitwiseXOR(F.col("bits")).alias("key"))


def near(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, same: bool = False) -> DataFrame:
    """All pairs (fingerprint of ``queries``, other of ``fps``, distance) within ``radius``; equal
    ones only if ``same``.  Repeated fingerprints of a side count as one."""
    q, x = asked(halves(queries), radius).alias("q"), tables(halves(fps), radius).alias("x")
    hi, lo = F.col("q.hi").bitwiseXOR(F.col("x.hi")), F.col("q.lo").bitwiseXOR(F.col("x.lo"))
    distance = F.bit_count(hi) + F.bit_count(lo)
    bits = lambda i: F.bit_count(F.shiftrightunsigned(
        hi if i < BLOCKS // 2 else lo, 48 - 16 * (i % (BLOCKS // 2))).bitwiseAND(0xFFFF))
    keeps = sum((F.when(bits(i) <= n, 1 << i).otherwise(0) for i, n in enumerate(allowed(radius))), F.lit(0))
    # the blocks below the key's own one: its bit less one
    below = F.expr("shiftleft(1, cast(shiftright(q.key, 16) as int)) - 1")
    back = lambda t: F.lower(F.concat(*(F.lpad(F.hex(f"{t}.{h}"), 16, "0") for h in ("hi", "lo"))))
    return (q.join(x, (F.col("q.key") == F.col("x.key")) & (distance <= radius) & (distance >= (0 if same else 1))
                   & (keeps.bitwiseAND(below) == 0))
            .select(back("q").alias("fingerprint"), back("x").alias("other"), distance.alias("distance")))


def matches(prints: DataFrame, queries: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(fingerprint of ``queries``, other, distance, n_docs, first_id): every fingerprint of
    ``prints`` within ``radius``, the equal one too, with the number of its documents and their
    smallest id.  Copies stay one row; all their ids are the rows of ``prints`` with ``other``."""
    held = prints.groupBy(F.col("fingerprint").alias("other")).agg(F.count("*").alias("n_docs"), F.min(id_col).alias("first_id"))
    return near(queries, prints, radius, same=True).join(held, "other").select(
        "fingerprint", "other", "distance", "n_docs", "first_id")


def searched(prints: DataFrame, id_col: str = "doc_id", every: int = 50, radius: int = RADIUS) -> DataFrame:
    """``prints`` with the search among all for documents whose id is divisible by ``every`` (the
    stated query set; null elsewhere):

    * n_near: other fingerprints within ``radius``;
    * n_copies: other documents with the same fingerprint;
    * n_near_docs: other documents within ``radius``, copies included;
    * matches: (distance, fingerprint, n_docs, first_id) of every fingerprint within ``radius``,
      the own one too, by distance.

    The table itself is the membership: the documents of a match are the rows of its fingerprint."""
    hit = F.coalesce(F.col(id_col) % every == 0, F.lit(False))
    asked_rows = prints.where(hit)
    found = matches(prints, asked_rows, id_col, radius).groupBy(F.col("fingerprint").alias("_fp")).agg(
        F.count_if(F.col("distance") > 0).alias("n_near"),
        F.sum(F.when(F.col("distance") == 0, F.col("n_docs") - 1)).alias("n_copies"),
        (F.sum("n_docs") - 1).alias("n_near_docs"),
        F.sort_array(F.collect_list(F.struct("distance", F.col("other").alias("fingerprint"), "n_docs", "first_id"))).alias("matches"))
    out = asked_rows.join(found, F.col("fingerprint") == F.col("_fp"), "left").drop("_fp")
    # only the asked rows are joined: a large group of copies elsewhere is not moved
    return out.unionByName(prints.where(~hit), allowMissingColumns=True)
