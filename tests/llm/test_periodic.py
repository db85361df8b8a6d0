"""Periodic runs against a comparison of every word with the word q later, for every q."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from barwright.llm import periodic, queries

SCHEMA = "doc_id long, text string, words string, runs int, best string, collapsed string, _id int, n_words int"


def brute(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q) and all(any(words[x] != words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(n):
    rnd = random.Random(8)
    for _ in range(n):
        s = []
        while len(s) < rnd.randint(1, 250):
            kind = rnd.random()
            if kind < .4:
                s += [rnd.randrange(2) for _ in range(rnd.randint(1, 20))]
            elif kind < .8:
                s += ([rnd.randrange(3) for _ in range(rnd.randint(1, 12))] * 20)[:rnd.randint(1, 150)]
            else:
                s += s[-rnd.randint(1, 60):] * rnd.randint(1, 4)
        yield s


def split(text):
    return [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]


def texts():
    out = [None, "", " \t\n ", "one", "a " * 23, "a " * 24, "a\x0ba\x0c" * 12, "é  b\t" * 12, "x " + "a b c " * 8 + "y", "A a " * 12]
    out += [" ".join(f"w{c}" for c in s) for s in sequences(60)]
    block = [f"v{i}" for i in range(900)]
    out.append(" ".join([*block[:50], *(block * 4), "end", *(["z"] * 500)]))  # long, hot word
    return out + [out[-2], out[-2]]


@pytest.mark.parametrize("seed", range(4))
def test_runs(seed):
    for s in list(sequences(1200))[seed::4]:
        assert periodic.runs_of(np.array(s)) == brute(s)


def test_strange_shapes():
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    for s in (fib[-1], "a" * 500, "ab" * 300, ("a" * 30 + "b") * 12, ("ab" * 20 + "c") * 7, "abcabcabd" * 25):
        codes = np.array([ord(c) for c in s])
        assert periodic.runs_of(codes) == brute(s)


def test_strongest_is_exact():
    runs = [(5, 30, 10), (3, 24, 8), (3, 27, 9), (9, 10**15 + 1, 3 * 10**14), (7, 10**15, 3 * 10**14)]
    assert periodic.strongest(runs) == runs[3]
    assert periodic.strongest(runs[:3]) == runs[1]
    assert periodic.strongest([]) is None


def expect(words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator(spark):
    rows = [(i if i != 3 else None, t, "w", 1, "b", "c", 2, 3) for i, t in enumerate(texts())]
    got = periodic.collapsed(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "n_words", "runs", "best", "collapsed"]
    want = sorted(((r[0], len(split(r[1])), *expect(split(r[1]))) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed) for r in got.collect()), key=repr) == want


def test_slices(monkeypatch):
    import pyarrow as pa
    whole = periodic.collapse(pa.array([t or "" for t in texts()]))
    assert [r for r in whole[1] if r]
    sizes = np.array([len(t or "") for t in texts()])
    monkeypatch.setattr(periodic, "SLICE", 200)
    parts = [periodic.collapse(pa.array([t or "" for t in texts()][a:z])) for a, z in periodic.slices(sizes)]
    assert [r for p in parts for r in p[1]] == whole[1]
    assert [t for p in parts for t in p[3].to_pylist()] == whole[3].to_pylist()


def test_query(spark, tmp_path):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts() * 2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        w = split(t)
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(len(w))]
        runs, best, text = expect(w)
        want.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(text)))
    got = [tuple(r) for r in queries.op12_periodic(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({r[1] for r in want}) > 2


def test_empty_table(spark):
    assert periodic.collapsed(spark.createDataFrame([], SCHEMA)).collect() == []
