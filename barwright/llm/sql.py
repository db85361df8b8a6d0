"""DuckDB SQL of the queries that SQL can express over whole tables.

Each text is written from the query's contract, with other means than the operator where there
are any: whole windows are joined as strings (op9), links come from counted common shingles and
components from a recursive reach (op3), spans from the pieces between matches (op8), budgets
from running sums in hash order (op7), the permutation from recursive rounds (op1)."""

from __future__ import annotations

import re

from barwright.llm import chat, licenses, sharding
from barwright.llm.divergence import LEAST_DOCS, TOP
from barwright.llm.mixing import PASSES
from barwright.llm.text import UPPER

TEXT = "coalesce(text, '')"
#: ASCII-lowered text, words without ASCII signs, words between ASCII white space
LOWER = f"translate({TEXT}, '{UPPER}', '{UPPER.lower()}')"
ALNUM = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WHITE = r"'[^\x20\x09-\x0D]+'"


#: table of the checksum's polynomial; its value over a list [4294967295, byte, byte ...] of {0}
CRC = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
CRC_OF = "xor(list_reduce({0}, lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295)"


def sharding_sql(shards: int = 24, seed: int = 1) -> str:
    """Row numbers by id through the Feistel rounds; values beyond n go round again."""
    mixed = "((({x} % {p} * {a} + {c}) % {p}) * (({x} % {p} * {a} + {c}) % {p}) + {c}) % {p}"
    step = "SELECT doc_id, a, b, n, x // b AS l, x % b AS r FROM {src}"
    for i, (mul, add) in enumerate(sharding._keys(seed)):
        side, other, mod = ("l", "r", "a") if i % 2 == 0 else ("r", "l", "b")
        f = mixed.format(x=other, p=sharding.P, a=mul, c=add)
        step = f"SELECT doc_id, a, b, n, {other}, ({side} + {f}) % {mod} AS {side} FROM ({step})"
    rounds = lambda src: f"SELECT doc_id, a, b, n, l * b + r AS x FROM ({step.format(src=src)})"
    return f"""
WITH RECURSIVE {CRC},
size AS (SELECT count(*) AS n, CAST(floor(sqrt(greatest(count(*), 1) - 1)) AS BIGINT) + 1 AS a FROM documents),
start AS (
  SELECT doc_id, a, greatest(1, (n + a - 1) // a) AS b, n, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS x
  FROM documents, size),
walk AS (
  {rounds("start")}
  UNION ALL
  {rounds("(SELECT * FROM walk WHERE x >= n)")}),
bytes AS (
  SELECT doc_id, strlen({TEXT}) + 8 AS size, [4294967295] || list_transform(
    regexp_extract_all(hex(encode({TEXT})), '..'), lambda y: CAST('0x' || y AS BIGINT)) AS v FROM documents)
SELECT doc_id, CAST(size AS BIGINT) AS size,
  {CRC_OF.format("v")} AS text_crc32,
  'rows' AS law, CAST(x % {shards} AS INTEGER) AS shard, CAST(x // {shards} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM bytes JOIN (SELECT doc_id, x FROM walk WHERE x < n) USING (doc_id), crc"""


def licenses_sql() -> str:
    phrases = ", ".join(f"('{t}', '{label}', true)" for t, label in licenses.PHRASES)
    passages = ", ".join(f"('{t}', '{label}', false)" for t, label in licenses.PASSAGES)
    k = licenses.K
    return f"""
WITH docs AS (SELECT doc_id, {ALNUM} AS w FROM documents),
template AS (SELECT label, exact, string_split(txt, ' ') AS w FROM (VALUES {phrases}, {passages}) v(txt, label, exact)),
gram AS (SELECT label, len(w) - 1 AS grams, q, w[q + 1] AS w1, w[q + 2] AS w2
  FROM (SELECT label, w, unnest(range(len(w) - 1)) AS q FROM template WHERE NOT exact)),
pos AS (SELECT doc_id, p, w[p + 1] AS w1, w[p + 2] AS w2 FROM (SELECT doc_id, w, unnest(range(len(w) - 1)) AS p FROM docs)),
-- base places: the phrase's words one after the other
base AS (SELECT d.doc_id, t.label, d.p AS place FROM (SELECT doc_id, w, unnest(range(len(w))) AS p FROM docs) d
  JOIN (SELECT * FROM template WHERE exact) t ON d.w[d.p + 1] = t.w[1] AND d.w[d.p + 1:d.p + len(t.w)] = t.w),
hit AS (SELECT doc_id, label, grams, q, p, p - q AS d FROM pos JOIN gram USING (w1, w2)),
diag AS (SELECT DISTINCT doc_id, label, d FROM hit),
run AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, label ORDER BY d) AS run FROM (
  SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, label ORDER BY d) <= {licenses.GAP} THEN 0 ELSE 1 END AS step
  FROM diag)),
-- grams in the words after every match, twice the passage's length
part AS (SELECT hit.*, run FROM hit JOIN run USING (doc_id, label, d)),
span AS (SELECT x.doc_id, x.label, count(DISTINCT y.q) / x.grams AS score FROM part x JOIN part y
  ON x.doc_id = y.doc_id AND x.label = y.label AND x.run = y.run AND y.p BETWEEN x.p AND x.p + 2 * (x.grams + {k}) - {k}
  GROUP BY x.doc_id, x.label, x.run, x.grams, x.p),
found AS (SELECT doc_id, label, place, 1.0::DOUBLE AS score FROM base
  UNION ALL SELECT doc_id, label, NULL, score FROM span WHERE score >= {licenses.COVER})
SELECT d.doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words, count(place) AS n_base,
  CAST(min(place) AS BIGINT) AS first_word, CAST(max(place) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (place IS NOT NULL), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0::DOUBLE) AS score
FROM docs d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id"""


JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, {WHITE}) AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM w),
class AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
item AS (SELECT c, n, unnest(s) AS e FROM class),
pair AS (SELECT x.c AS a, y.c AS b, x.n AS na, y.n AS nb, count(*) AS i FROM item x JOIN item y
  ON x.e = y.e AND x.c < y.c AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n GROUP BY ALL),
link AS (SELECT a, b FROM pair WHERE 100 * i >= 90 * (na + nb - i)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT c, c AS other FROM class UNION SELECT r.c, b.b FROM reach r JOIN edge b ON r.other = b.a),
low AS (SELECT c, min(other) AS low FROM reach GROUP BY c)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(low.low, s.doc_id) AS component_id
FROM s LEFT JOIN class USING (s) LEFT JOIN low USING (c)"""


def mixing_sql(passes: int = PASSES) -> str:
    """Targets by the capped prefix of sources; then per pass the documents in hash order that
    still fit, later passes over those not above what the pass before left open."""
    ctes = []
    state = "SELECT src, CASE WHEN s > 0 THEN target - copies * s ELSE 0.0 END AS rem, -1 AS edge, 1::BIGINT << 62 AS cap FROM plan"
    for i in range(passes):
        ctes.append(f"""
st{i} AS ({state}),
in{i} AS (SELECT d.src, h, size, sum(size) OVER (PARTITION BY d.src ORDER BY h) AS cum, rem
  FROM docs d JOIN st{i} t ON d.src IS NOT DISTINCT FROM t.src AND h > edge AND size <= cap),
cut{i} AS (SELECT t.src, t.cap, coalesce(max(h) FILTER (cum <= i.rem), t.edge) AS cut,
  t.rem - coalesce(max(cum) FILTER (cum <= i.rem), 0) AS rem
  FROM st{i} t LEFT JOIN in{i} i ON i.src IS NOT DISTINCT FROM t.src GROUP BY t.src, t.cap, t.edge, t.rem)""")
        state = f"SELECT src, rem, cut AS edge, CAST(floor(rem) AS BIGINT) AS cap FROM cut{i}"
    joins = "\n".join(f"JOIN cut{i} ON cut{i}.src IS NOT DISTINCT FROM d.src" for i in range(passes))
    once = " OR ".join(f"(h <= cut{i}.cut AND size <= cut{i}.cap)" for i in range(passes))
    return f"""
WITH docs AS (SELECT doc_id, source AS src, len(regexp_extract_all({TEXT}, {WHITE})) AS size,
  CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5({TEXT})), 1, 15) AS BIGINT) AS h
  FROM documents),
sizes AS (SELECT src, s, [5, 2, 1][(row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 + 1] AS w
  FROM (SELECT src, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY src)),
-- capped first: sources in order of size by weight, what is left for each and those after it
ranked AS (SELECT *, sum(s) OVER () - 3 * coalesce(sum(s) OVER (ORDER BY s / w, src NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
  sum(w) OVER (ORDER BY s / w, src NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wleft FROM sizes),
first AS (SELECT remain, wleft FROM ranked WHERE remain / wleft * w <= 3 * s ORDER BY s / w, src NULLS FIRST LIMIT 1),
plan AS (SELECT src, s, target, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS copies FROM (
  SELECT r.src, r.s, CASE WHEN r.remain / r.wleft * r.w > 3 * r.s THEN CAST(3 * r.s AS DOUBLE)
    ELSE CAST(r.w * f.remain AS DOUBLE) / CAST(f.wleft AS DOUBLE) END AS target FROM ranked r LEFT JOIN first f ON true)),
{",".join(ctes)}
SELECT d.doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
  CAST(size * (copies + CASE WHEN {once} THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN plan ON plan.src IS NOT DISTINCT FROM d.src
{joins}"""


def any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def secrets_sql() -> str:
    names = "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + "|" + any_case("api") + "_?" + any_case("key")
    kinds = (("assign", f"({names})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6, True),
             ("access", "AKIA[A-Z0-9]+", 0, 20, True), ("hex", "[0-9a-f]+", 0, 24, True),
             ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, False),
             ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, False),
             ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 0, False))
    parts = "\nUNION ALL ".join(
        f"SELECT doc_id, {i} AS rank, '{kind}' AS kind, {str(base).lower()} AS base, {least} AS least, "
        f"regexp_split_to_array(t, '{p}') AS gap, regexp_extract_all(t, '{p}') AS hit, regexp_extract_all(t, '{p}', {g}) AS val FROM docs"
        for i, (kind, p, g, least, base) in enumerate(kinds))
    return f"""
WITH docs AS (SELECT doc_id, {TEXT} AS t FROM documents),
raw AS ({parts}),
each AS (SELECT doc_id, rank, kind, base, least, unnest(range(1, len(hit) + 1)) AS i, unnest(gap[:len(hit)]) AS gap,
  unnest(hit) AS hit, unnest(val) AS val FROM raw),
span AS (SELECT *, stop - length(hit) AS start FROM (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (
  PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS stop FROM each) WHERE length(val) >= least),
named AS (SELECT doc_id, rank, kind, base, start, kind || ':' || start || ':' || stop AS s FROM span)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY start, rank), '') AS spans
FROM docs d LEFT JOIN named n USING (doc_id) GROUP BY d.doc_id"""


DECONTAM = f"""
WITH docs AS (SELECT doc_id, {ALNUM} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
place AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM win))),
found AS MATERIALIZED (SELECT doc_id, item, i, n, win FROM place JOIN win USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id),
-- proximity: the second rarest word of a window within three words of its place, counted from
-- the rarest one, where the window itself does not stand
tok AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
rare AS (SELECT win, n, word, o, row_number() OVER (PARTITION BY win ORDER BY c, word, o) AS r, c FROM (
  SELECT win, n, word, o, coalesce(c, 0) AS c FROM (
    SELECT win, n, unnest(string_split(win, ' ')) AS word, unnest(range(n)) AS o FROM (SELECT DISTINCT win, n FROM win))
  LEFT JOIN (SELECT word, count(*) AS c FROM tok GROUP BY word) USING (word))),
lead AS MATERIALIZED (SELECT x.win, x.n, x.word AS w1, x.o AS o1, y.word AS w2, y.o AS o2 FROM rare x JOIN rare y USING (win)
  WHERE x.r = 1 AND y.r = 2 AND x.c > 0),
cand AS MATERIALIZED (SELECT x.doc_id, win, x.p - o1 AS s, w2, x.p - o1 + o2 + unnest(range(-3, 4)) AS p
  FROM tok x JOIN lead ON x.word = w1),
close AS (SELECT DISTINCT doc_id, win, s FROM cand JOIN (SELECT doc_id, word AS w2, p FROM tok) y USING (doc_id, w2, p)),
near AS (SELECT doc_id, count(*) AS n_near FROM close c ANTI JOIN found l
  ON l.doc_id = c.doc_id AND l.i = c.s + 1 AND l.win = c.win GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN near USING (doc_id)"""


def divergence_sql(least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    """Counts of every kept term in every group, absent ones too, then differences term by term."""
    p = lambda n, total: f"(1 + 1000000000::HUGEINT * ({n} + 5) // ({total} + 5 * v))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
t AS (SELECT lang, source, term, sum(n) AS n, count(*) AS docs FROM c GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS m FROM t GROUP BY ALL HAVING sum(docs) >= {least_docs}),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n, k.m FROM grp g JOIN kept k USING (lang) LEFT JOIN t USING (lang, source, term)),
tot AS (SELECT lang, source, sum(n) AS total, sum(m) AS whole, count(*) AS v FROM n GROUP BY ALL),
p AS (SELECT n.*, {p("n", "total")} AS p, {p("m", "whole")} AS q FROM n JOIN tot USING (lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
  AND a.source <> b.source GROUP BY ALL),
item AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang
    AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM item)
WHERE part = 'pair' OR rank <= {top}"""


#: runs are the unbroken stretches of positions whose next 16 words stand again q words later
PERIODIC = f"""
WITH {CRC},
given AS (SELECT doc_id, regexp_extract_all({TEXT}, {WHITE}) AS w, CASE WHEN doc_id IS NULL THEN 1 ELSE {CRC_OF.format(
    "([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda y: CAST(ascii(y) AS BIGINT)))")} END AS h
  FROM documents, crc),
base AS (SELECT *, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS changed, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a,
  CASE WHEN len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) ELSE 1 END AS p FROM given),
docs AS (SELECT doc_id, n, CASE WHEN changed THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
  ELSE w END AS w FROM base),
gram AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 16], ' ') AS g FROM (SELECT doc_id, w, unnest(range(n - 15)) AS i FROM docs WHERE n >= 24)),
twice AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
part AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM twice),
stretch AS (SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 16 + q AS len FROM part GROUP BY doc_id, q, island),
long AS (SELECT * FROM stretch WHERE len >= greatest(24, 3 * q)),
run AS (SELECT * FROM long x WHERE NOT EXISTS (SELECT 1 FROM long y WHERE y.doc_id = x.doc_id AND y.q < x.q AND x.q % y.q = 0
  AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
best AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
  first(struct_pack(s := s, len := len, q := q) ORDER BY len / q DESC, s, q) AS b FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM docs)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period, 1000 * b.len // b.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def chat_sql(template: chat.Template = chat.DEFAULT) -> str:
    trap = r"\### Assistant: </turn> ok"
    opens = " ".join(f"WHEN '{r}' THEN {len(s)}" for r, s in template.opening.items())
    signs = "|".join([r"\\", *(re.escape(s) for s in template.controls())])
    moves = " ".join(f"WHEN '{s}>{r}' THEN true" for (s, r) in template.moves)
    order = "turn NULLS FIRST, role, text"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{trap}'),
-- the state after an allowed move bears the name of its role
m AS (SELECT *, CASE coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY {order}), 'start') || '>' || role {moves} ELSE false END AS allowed FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {order})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE role {opens} END + length(text) + len(regexp_extract_all(text, '{signs}')) + {len(template.closing)}) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AS order_ok, bool_and(allowed) AND last(role ORDER BY {order}) = 'assistant' AS complete
FROM m GROUP BY conv_id"""


ORACLES = {"op1_sharding": sharding_sql(), "op2_licenses": licenses_sql(), "op3_jaccard": JACCARD, "op7_mixing": mixing_sql(),
           "op8_secrets": secrets_sql(), "op9_decontam": DECONTAM, "op11_divergence": divergence_sql(), "op12_periodic": PERIODIC,
           "op13_chat": chat_sql()}
