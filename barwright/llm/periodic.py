"""Periodic runs of words inside a text, and the text with repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of
at least ``max(LEAST, 3 * q)`` words, that no neighbouring word extends.

Method (descending-LCP Kruskal): the edges between neighbours in suffix order are taken by
decreasing length of their common prefix (LCP).  Each unites two classes of suffixes with
union-find, the smaller ordered set of positions into the larger one.  Two positions that become
neighbours in the united set, q apart with q <= LCP, seed a run of period q: no position between
them shares that prefix, so q is the smallest period, and one word more would differ.  The
leftmost seed of a run has its whole length, LCP + q.

A run of ``LEAST`` = 24 or more words and 3 periods repeats its first LEAST * 2 / 3 = 16 words
after one period, so only positions whose next 16 words occur twice in the text matter; they are
found by hashes of whole slices of texts, and all others are exactly those without an edge.

Words are runs of non-white characters.  They stay in Arrow columns; a task holds a slice of
``SLICE`` bytes (or one longer text) with its words at once.

Defined cases: null or empty text has no words, no runs and an empty collapsed text; ties between
runs go by start, then period; repeated rows are rows of their own; an empty table gives an empty
result; further columns are ignored."""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.hashing import U64, mixed

LEAST = 24
#: words that any run repeats after one period
GRAM = LEAST * 2 // 3
WHITE = r"[\x20\x09-\x0D]+"
SLICE = 4 << 20

Run = tuple[int, int, int]  # start, length, period


def repeated_grams(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Positions whose next GRAM words (of the same text) occur again in that text, by hash."""
    n = len(codes) - GRAM + 1
    if n < 2:
        return np.empty(0, np.int64)
    h = mixed(codes.astype(U64) + U64(1))
    for w in (1 << i for i in range(GRAM.bit_length() - 1)):
        h = mixed(h[:-w] * U64(0x9E3779B97F4A7C15) + h[w:])
    at = np.flatnonzero(doc[:n] == doc[GRAM - 1:])
    key = mixed(h[at] ^ mixed(doc[at].astype(U64) + U64(1)))
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    return at[twice[place] == key]


def dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks from 0, equal for equal keys, of rows sorted by ``order``."""
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_edges(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the LCP of each with the next one, for the positions whose next GRAM
    words are repeated (and those GRAM words behind them, which decide the order at the edges).

    Ranks by 16, 32, 64 ... words: two suffixes with the same rank by k words have suffixes k
    words later that are among these positions too."""
    n = len(codes)
    pos = np.unique(np.concatenate([at, at + GRAM]))
    index = np.full(n + GRAM + 1, -1, np.int64)
    index[pos] = np.arange(len(pos))
    padded = np.zeros(n + 2 * GRAM, np.int64)
    padded[:n] = codes + 1
    bits = max(1, int(padded.max()).bit_length())
    per, keys = max(1, 63 // bits), []
    for j in range(0, GRAM, per):  # several words in one sort key
        key = np.zeros(len(pos), np.int64)
        for t in range(j, min(j + per, GRAM)):
            key = (key << bits) | padded[pos + t]
        keys.append(key)
    ranks = [dense(np.lexsort(keys[::-1]), *keys)]
    k = GRAM
    while ranks[-1].max() < len(pos) - 1:
        later = index[np.minimum(pos + k, n + GRAM)]
        key = ranks[-1] * (len(pos) + 1) + np.where(later < 0, 0, ranks[-1][later] + 1)
        ranks.append(dense(np.argsort(key, kind="stable"), key))
        k *= 2
    order = pos[np.argsort(ranks[-1])]
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(len(order) - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        k = GRAM << level
        i, j = index[a], index[b]
        same = np.flatnonzero((i >= 0) & (j >= 0))
        same = same[ranks[level][i[same]] == ranks[level][j[same]]]
        for x in (a, b, lcp):
            x[same] += k
    some = np.flatnonzero(lcp >= GRAM)  # fewer words than GRAM are left to compare
    live = some
    for _ in range(GRAM):
        live = live[(a[live] < n) & (b[live] < n)]
        live = live[codes[a[live]] == codes[b[live]]]
        for x in (a, b, lcp):
            x[live] += 1
    return order, lcp


def seeds(order: np.ndarray, lcp: np.ndarray) -> list[Run]:
    """(position, period, LCP) of positions that become neighbours within their LCP."""
    edge = np.flatnonzero(lcp >= GRAM)
    edge = edge[np.argsort(-lcp[edge], kind="stable")]
    parent = list(range(len(order)))
    sets: list[list[int]] = [[p] for p in order.tolist()]
    out: list[Run] = []
    for e, common in zip(edge.tolist(), lcp[edge].tolist(), strict=True):
        a, b = e, e + 1
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if len(sets[a]) > len(sets[b]):
            a, b = b, a
        few, many = sets[a], sets[b]
        last = -1
        for i, x in enumerate(few):
            p = bisect(many, x)
            if p and last < many[p - 1] and x - many[p - 1] <= common:
                out.append((many[p - 1], x - many[p - 1], common))
            if p < len(many) and many[p] - x <= common and (i + 1 == len(few) or few[i + 1] > many[p]):
                out.append((x, many[p] - x, common))
            last = x
        if 8 * len(few) > len(many):
            many += few
            many.sort()
        else:
            for x in few:
                insort(many, x)
        sets[a] = []
        parent[a] = b
    return out


def runs_of(codes: np.ndarray, at: np.ndarray | None = None) -> list[Run]:
    """Runs (start, length, period) of a sequence of word codes, by start, then period.  ``at``:
    positions whose next GRAM words are repeated, if known."""
    if at is None:
        at = repeated_grams(codes, np.zeros(len(codes), np.int64))
    if len(at) < 2:
        return []
    found = seeds(*suffix_edges(codes, at))
    if not found:
        return []
    start, q, common = np.array(found, np.int64).T
    whole = (common + q >= LEAST) & (common >= 2 * q)
    start, q, common = start[whole], q[whole], common[whole]
    first = (start == 0) | (codes[start - 1] != codes[start - 1 + q])  # nothing to extend on the left
    return sorted(zip(start[first].tolist(), (common + q)[first].tolist(), q[first].tolist(), strict=True), key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """Run of the greatest length / period; ties by start, then period."""
    best = None
    for r in runs:
        if best is None or (d := r[1] * best[2] - best[1] * r[2]) > 0 or d == 0 and (r[0], r[2]) < (best[0], best[2]):
            best = r
    return best


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and total + n > SLICE:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def collapse(texts: pa.Array) -> tuple[pa.Array, list[list[Run]], list[Run | None], pa.Array]:
    """Word counts, runs, strongest runs and collapsed texts of a slice of texts."""
    parts = pc.split_pattern_regex(texts, WHITE)
    words, doc = parts.flatten(), pc.list_parent_indices(parts).to_numpy().astype(np.int64)
    full = pc.not_equal(words, "")
    words, doc = words.filter(full), doc[full.to_numpy(zero_copy_only=False)]
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    at = repeated_grams(codes, doc)
    bounds = np.searchsorted(at, first)
    runs: list[list[Run]] = [[] for _ in range(len(texts))]
    change = np.zeros(len(codes) + 1, np.int64)  # +1 where dropped words begin, -1 behind them
    for d in np.unique(doc[at]).tolist():
        a, b = first[d], first[d + 1]
        runs[d] = runs_of(codes[a:b], at[bounds[d]:bounds[d + 1]] - a)
        for start, length, q in runs[d]:
            change[a + start + q] += 1
            change[a + start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    ends = np.concatenate(([0], np.cumsum(keep)))[first]
    kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(keep)))
    return pa.array(np.diff(first)), runs, [strongest(r) for r in runs], pc.binary_join(kept, " ")


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (array of start, length, period by start, then
    period), best (the run of most periods, or null), collapsed (the text's words without those
    that any run repeats after its first period, joined by one space)."""
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    names = ["_id", "n_words", "runs", "best", "collapsed"]

    def tuples(rows: list) -> list:
        return [r and dict(zip(("start", "length", "period"), r, strict=True)) for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in slices(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False)):
                n, runs, best, text = collapse(b.column(1).slice(a, z - a))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), n, pa.array([tuples(r) for r in runs], RUN_TYPE),
                     pa.array(tuples(best), RUN_TYPE.value_type), text], names)
    one = "struct<start: long, length: long, period: long>"
    return src.mapInArrow(run, f"_id {src.schema['_id'].dataType.simpleString()}, n_words long, runs array<{one}>, best {one}, "
                               "collapsed string").withColumnRenamed("_id", id_col)
