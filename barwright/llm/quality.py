"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (toxic), 1 (poor) and 2 (good).  One weight vector over hashed words and style
buckets gives a score f; ordered thresholds t0 < t1 give P(grade <= j) = logistic(t_j - f).  All
grades share the weights, so every rating informs the whole scale; the expected grade and the
tail probabilities P(grade >= j) come from one score.

The model is fitted on at most ``SAMPLE`` labelled rows (those with the smallest hash of their
id; a documented bound), by proximal AdaGrad with an L1 penalty on the mean negative
log-likelihood; every document is scored, from its whole text.

Defined cases: null or empty text has only style buckets; labels without a quality are ignored,
repeated labels count once with the lowest grade; without any label the score is 0 and every
document is kept; an empty table gives an empty result."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 8_192
SLOTS = 1 << 18
#: style buckets: shares of character kinds and of distinct words, in eighths of a logarithmic scale
STYLES = ("upper", "digit", "symbol", "bar", "bang", "distinct", "longest")
LEVELS = 9
SIZE = SLOTS + len(STYLES) * LEVELS
EPOCHS, BATCH, RATE, L1 = 8, 64, 0.15, 2e-4
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
MEMORY = 500_000


class Slots(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        out = self[w] = xxhash.xxh64_intdigest(w) % SLOTS
        return out


def features(text: str | None, slots: Slots) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    words = WORDS.findall(raw.lower())
    unique = set(words)
    level = lambda share: int(min(LEVELS - 1, max(0, np.ceil(LEVELS - 1 + np.log2(max(share, 1e-9))))))
    letters = chars[65:91].sum() + chars[97:123].sum()
    symbols = chars[[35, 36, 37, 38, 42, 60, 61, 62, 64, 92, 94, 95, 123, 125, 126]].sum()
    shares = (chars[65:91].sum() / max(1, letters), chars[48:58].sum() / n, symbols / n, chars[124] / n, chars[33] / n,
              len(unique) / max(1, len(words)), max(map(len, unique), default=0) / n)
    style = [SLOTS + i * LEVELS + level(s) for i, s in enumerate(shares)]
    return np.unique(np.array([*map(slots.__getitem__, unique), *style], np.int64))


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Shared weights and ordered thresholds."""
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return logistic(score - self.cuts)

    def score(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum())


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = 3) -> Model:
    """Proximal AdaGrad on the cumulative-link likelihood; rows are feature numbers."""
    w, seen = np.zeros(SIZE), np.full(SIZE, 1e-6)
    if not len(grades):
        return Model(w, np.full(n_grades - 1, -30.0))
    share = np.array([(grades <= j).mean() for j in range(n_grades - 1)]).clip(1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    cuts += np.arange(n_grades - 1) * 1e-3
    cut_seen = np.full(n_grades - 1, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        perm = order.permutation(len(grades))
        for at in range(0, len(perm), BATCH):
            part = perm[at:at + BATCH]
            flat = np.concatenate([rows[i] for i in part])
            lens = np.array([len(rows[i]) for i in part])
            f = np.add.reduceat(w[flat], np.concatenate(([0], np.cumsum(lens)[:-1])))
            y = grades[part]
            edge = np.concatenate(([-np.inf], cuts, [np.inf]))
            hi, lo = logistic(edge[y + 1] - f), logistic(edge[y] - f)
            hi, lo = np.where(y == n_grades - 1, 1.0, hi), np.where(y == 0, 0.0, lo)
            p = np.maximum(hi - lo, 1e-9)
            slope = (1.0 - hi - lo) / len(part)  # of the loss in f
            used, back = np.unique(flat, return_inverse=True)
            g = np.bincount(back, weights=np.repeat(slope, lens), minlength=len(used))
            seen[used] += g * g
            step = RATE / np.sqrt(seen[used])
            moved = w[used] - step * g
            w[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0.0)
            gc = np.zeros(n_grades - 1)
            for j in range(n_grades - 1):
                gc[j] = (-(hi * (1 - hi) / p)[y == j].sum() + (lo * (1 - lo) / p)[y == j + 1].sum()) / len(part)
            cut_seen += gc * gc
            cuts = np.maximum.accumulate(cuts - RATE * gc / np.sqrt(cut_seen))
            cuts += np.arange(n_grades - 1) * 1e-6
    return Model(w, cuts)


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, grade) of the labels: 0 toxic, 1 poor, 2 good."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    return (labels.where(F.col(id_col).isNotNull() & (F.col("quality").isNotNull() | toxic))
            .groupBy(F.col(id_col).alias("_id"))
            .agg(F.min(F.when(toxic, 0).when(F.col("quality") == 0, 1).otherwise(2)).alias("grade")))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            sample: int = SAMPLE) -> Model:
    """Model fitted on at most ``sample`` labelled documents."""
    picked = graded(labels, id_col).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")).join(
        F.broadcast(picked), "_id").select("_id", "grade", "_t")  # at most ``sample`` rows on this side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots()
        for b in batches:
            rows = [features(t, slots).astype(np.int32) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.int32()))],
                                             ["_id", "grade", "f"])
    kind = src.schema["_id"].dataType.simpleString()
    rows = (src.mapInArrow(run, f"_id {kind}, grade int, f array<int>").groupBy("_id")
            .agg(F.min("grade").alias("grade"), F.max("f").alias("f")).toArrow().sort_by("_id"))
    return fit([np.asarray(x.as_py(), np.int64) for x in rows.column("f")], rows.column("grade").to_numpy())


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_all: bool = True) -> DataFrame:
    """``docs`` with expected_grade, p_poor_up = P(grade >= 1), p_good = P(grade >= 2); columns of
    these names are replaced.  ``keep_all`` False: only the id beside them."""
    docs = docs.drop("expected_grade", "p_poor_up", "p_good")
    if not keep_all:
        docs = docs.select(id_col, text_col)
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts))
    out_cols = [c for c in docs.columns if keep_all or c != text_col]
    places = [docs.columns.index(c) for c in out_cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, known = Slots(), Model(*held.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                b = whole.slice(start, 1000)
                tails = np.array([known.tails(known.score(features(None if t is None else str(t), slots)))
                                  for t in b.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i) for i in places), pa.array(tails.sum(axis=1)),
                     pa.array(tails[:, 0]), pa.array(tails[:, -1])],
                    [*out_cols, "expected_grade", "p_poor_up", "p_good"])
    schema = docs.select(*out_cols).schema
    for c in ("expected_grade", "p_poor_up", "p_good"):
        schema = schema.add(c, "double")
    return docs.mapInArrow(run, schema)
