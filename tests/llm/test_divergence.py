"""Source divergence audit against plain dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from barwright.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, found int, rank int, n long"


def brute(rows, least, top):
    count, docs, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        n = {s: sum(count[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (count[lang, s, t] + 5) // (n[s] + 5 * len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(count[lang, s, t] for s in sources) + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s, t] - p[o, t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s, t] - q[t], t) for t in kept if count[lang, s, t] and p[s, t] > q[t]]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for i, (v, x) in enumerate(sorted(items, key=lambda y: (-y[0], y[1].encode()))[:last]):
                    out.append((lang, s, part, x, v, i + 1))
    return sorted(out)


def rows():
    rnd = random.Random(5)
    words = ["the", "The", "und", "é", "Éa", "x1y", "don't", "日本", "ñandú", "zz", "K", "K", "ß-ß", "\x00a", "a\x7fb"]
    out = [(None, "en", "a"), ("", "en", "b"), ("12 34 --", "de", "only"), (None, None, None), ("the the", None, "a")]
    for i in range(150):
        text = " ".join(rnd.choices(words, weights=[1 + (j * i) % 7 for j in range(len(words))], k=rnd.randint(1, 60)))
        out.append((text, rnd.choice(["en", "en", "de", None]), "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])))
    out += [out[20], out[20]]  # repeated rows are documents of their own
    out.append((" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000)), "en", "long"))
    return out


def result(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, *r, "x", 1, 2, 3) for i, r in enumerate(rows())], SCHEMA).repartition(3)


@pytest.mark.parametrize(("least", "top"), [(30, 50), (1, 3), (2, 50), (10_000, 50)])
def test_against_dictionaries(docs, least, top):
    assert result(divergence.divergences(docs, least, top)) == brute(rows(), least, top)


def test_small_slices_pieces_and_matrices(docs, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "SLICE", 300)
    monkeypatch.setattr(divergence, "HELD", 100)
    cols = [pa.array([x or "" for x in c], pa.string()) for c in zip(*rows(), strict=True)]
    got = Counter()
    for b in divergence.partial_counts(iter([pa.RecordBatch.from_arrays([cols[1], cols[2], cols[0]], ["lang", "source", "text"])])):
        for r in b.to_pylist():
            got[r["lang"], r["source"], r["term"], "n"] += r["n"]
            got[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    want = Counter()
    for text, lang, source in rows():
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        for t, n in Counter(terms).items():
            want[lang or "", source or "", t, "n"] += n
            want[lang or "", source or "", t, "docs"] += 1
    assert {k: v for k, v in got.items() if k[2] is not None} == dict(want)
    # a matrix of one term at a time gives the same sums
    found = [[{"source": "a", "n": i}, {"source": "b", "n": 2 * i % 5 + 1}] for i in range(1, 40)]
    kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
    terms = pa.array([f"t{i}" for i in range(len(found))])
    sums = []
    for cells in (1, 1 << 20):
        monkeypatch.setattr(divergence, "CELLS", cells)
        x = divergence.Lang(["a", "b", "none"], np.array([780, 117, 0]), len(found), 5)
        x.add(terms, pa.array(found, kind))
        sums.append(list(x.rows("l")))
    assert sums[0] == sums[1]


def test_shares_are_exact_for_large_counts():
    rnd = random.Random(2)
    for _ in range(300):
        total = rnd.randint(6, 9 * 10**15)
        n = rnd.randint(0, total - 5)
        got = divergence.shares(np.array([[n]], np.int64), np.array([total], np.int64))
        assert int(got[0, 0]) == 1 + 10**9 * (n + 5) // total


def test_empty_table(spark):
    assert divergence.divergences(spark.createDataFrame([], SCHEMA)).collect() == []
