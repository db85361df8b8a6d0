"""Plain single-process versions of the operators' contracts."""

import hashlib
import re
import zlib
from collections import defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def white(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k):
    w = white(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def components(docs, k, percent):
    """{row index: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = [shingle_set(t, k) for _, t in docs]
    post = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            post[x].append(i)
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for i, s in enumerate(sets):
        both = defaultdict(int)
        for x in s:
            for j in post[x]:
                if j > i:
                    both[j] += 1
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(len(s), low.get(root(i))) for i, s in enumerate(sets)]


def base_licenses(text):
    w = alnum(text)
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    t = text or ""
    spans = [("assign", m) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    spans += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [("hex", m) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    spans.sort(key=lambda s: (s[1].start(), kinds.index(s[0])))
    text = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in spans)
    return (*(sum(k == x for k, _ in spans) for x in kinds), hashlib.sha256(text.encode()).hexdigest(), text)


def contamination(docs, items, size=10):
    """[(n_words, n_hit, n_items, items_sha256)] per document."""
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        if w:
            for i in range(max(1, len(w) - size + 1)):
                windows[tuple(w[i:i + size])].add(str(item) if item is not None else "null")
    lens = sorted({len(x) for x in windows})
    out = []
    for _, text in docs:
        w, hit, got = alnum(text), set(), set()
        for n in lens:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    got |= windows[x]
        out.append((len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()))
    return out


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} by resharing the excess until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - most * sum(sizes[s] for s in capped)
        total = sum(w[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and w[s] * left / total > most * sizes[s] + 1e-9}
        if not new:
            return {s: most * sizes[s] if s in capped else w[s] * left / total for s in names}
        capped |= new


def crc(text):
    return zlib.crc32((text or "").encode())


def edited(docs):
    """[(id, n_chars, edited text, next text)] in the order of ids (null first), ring-wise."""
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        out.append((d, len(t), t[:len(t) - half] + nxt[:half], nxt))
    return out


def greedy_pieces(word, vocabulary):
    """(pieces, unknown bytes) by greedy longest match."""
    n = unknown = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocabulary:
                at = end
                break
        else:
            at, unknown = at + 1, unknown + 1
        n += 1
    return n, unknown
