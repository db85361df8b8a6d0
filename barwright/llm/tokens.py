"""Token counts by a linear longest-match automaton.

A trie over the vocabulary's byte strings gets failure links: where the walk of a word cannot
go on at a node, the link leads to the node at which greedy longest matching would stand after
giving out the pieces matched so far, and the number of these pieces is stored with the link.
Each byte is read once, no piece is built, and the sum of popped pieces is the greedy count.

A word is a run of non-white characters; every word but a text's first is matched with one
space before it, as byte-level vocabularies store words.  Counts of words met before are
remembered by the task (bounded, then started anew).

Defined cases: null or empty text has no words and no pieces; a byte that no vocabulary entry
covers counts as one unknown piece; repeated rows are counted as rows of their own; an empty
table gives an empty result."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMORY = 500_000


def ranks(path: str) -> list[bytes]:
    """Entries of a vocabulary file: one base64 string and its number per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton(dict):
    """word -> (pieces, unknown); ``__missing__`` walks the word once."""

    def __init__(self, vocabulary: Iterable[bytes]):
        super().__init__()
        self.next: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in vocabulary:
            at = 0
            for byte in piece:
                to = self.next[at].get(byte)
                if to is None:
                    to = self.next[at][byte] = len(self.next)
                    self.next.append({})
                    whole.append(False)
                at = to
            whole[at] = at > 0
        # failure links in order of depth; -1: no entry is a prefix of what is pending
        self.link, self.popped = [-1] * len(self.next), [0] * len(self.next)
        todo = deque((0, byte, to) for byte, to in self.next[0].items())
        while todo:
            parent, byte, node = todo.popleft()
            todo.extend((node, b, to) for b, to in self.next[node].items())
            if whole[node]:
                self.link[node], self.popped[node] = 0, 1
                continue
            at, n = self.link[parent], self.popped[parent]
            while at > 0 and byte not in self.next[at]:
                n += self.popped[at]
                at = self.link[at]
            if at >= 0 and byte in self.next[at]:
                self.link[node], self.popped[node] = self.next[at][byte], n

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > MEMORY:
            self.clear()
        out = self[word] = self.walk(word)
        return out

    def walk(self, word: bytes) -> tuple[int, int]:
        """Greedy longest-match (pieces, unknown bytes).  A pending prefix of which no entry is a
        prefix is unknown in its first byte, and the rest is matched anew."""
        at, n, unknown, begin, i = 0, 0, 0, 0, 0
        nxt, link, popped = self.next, self.link, self.popped
        while True:
            if i < len(word) and (to := nxt[at].get(word[i])) is not None:
                if at == 0:
                    begin = i
                at, i = to, i + 1
            elif at == 0:
                if i >= len(word):
                    return n + unknown, unknown
                unknown, i = unknown + 1, i + 1
            elif link[at] >= 0:
                n += popped[at]
                at = link[at]
                if at:  # pending bytes are those that lead to the node
                    begin = i - self.depth(at)
            else:
                i, at, unknown = begin + 1, 0, unknown + 1

    def depth(self, node: int) -> int:
        if not hasattr(self, "_depth"):
            self._depth = [0] * len(self.next)
            for parent, kids in enumerate(self.next):  # children have larger numbers
                for to in kids.values():
                    self._depth[to] = self._depth[parent] + 1
        return self._depth[node]


def counted(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_pieces, n_unknown, n_bytes.  ``vocabulary``: file
    that every executor has, read once a task."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    names = ["_id", "n_words", "n_pieces", "n_unknown", "n_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(vocabulary)
        get = auto.__getitem__
        for b in batches:
            out = [[] for _ in range(4)]
            for t in b.column(1).to_pylist():
                raw = t.encode("utf-8", "surrogatepass") if t else b""
                words = raw.split()
                got = [get(w) for w in [words[0], *(b" " + w for w in words[1:])]] if words else []
                for col, v in zip(out, (len(words), sum(g[0] for g in got), sum(g[1] for g in got), len(raw))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in out)], names)
    schema = f"_id {src.schema['_id'].dataType.simpleString()}, n_words long, n_pieces long, n_unknown long, n_bytes long"
    return src.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


_READY: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, one per Python worker."""
    if path not in _READY:
        _READY.clear()
        _READY[path] = Automaton(ranks(path))
    return _READY[path]
