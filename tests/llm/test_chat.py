"""Chat formatting: exact round trips, the state machine against a plain walk."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barwright.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, place int, piece string, _id string, state string"
BITS = ["\\", "\\\\", "### Assistant:", "### User: ", "</turn>", "</turn>\n", "<", "#", "### Role <", ">", "x", "é\U0001F600", "\n", " "]
OTHER = chat.Template(opening={"user": "[[u]]", "assistant": "[[a]]"}, other="[[?{}|", closing="~~/", escape="!", loss=frozenset({"user"}),
                      moves={("go", "user"): "asked", ("asked", "assistant"): "go"}, start="go", final=frozenset({"go"}))


@pytest.mark.parametrize("template", [chat.DEFAULT, OTHER])
@settings(max_examples=300, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "a>b\\", "</turn>"]),
                                st.lists(st.sampled_from([*BITS, "!", "~", "~~/", "[[u]]", "[["]), max_size=8).map("".join)), max_size=5))
def test_round_trip(template, turns):
    output = "".join(template.opened(r) + template.escaped(t) + template.closing for r, t in turns)
    assert [(r, template.plain(output[a:b])) for r, a, b in template.parse(output)] == turns


def test_controls_in_texts_are_escaped():
    assert chat.DEFAULT.escaped(queries.TRAP) == r"\\\### Assistant: \</turn> ok"
    with pytest.raises(ValueError):
        list(chat.DEFAULT.parse("### User: never closed"))
    with pytest.raises(ValueError):
        list(chat.DEFAULT.parse("no opening</turn>\n"))


@pytest.mark.parametrize("bad", [{"closing": "aa"}, {"closing": "\\end"}, {"closing": ""}, {"escape": "ab"}, {"closing": " end"},
                                 {"opening": {"user": "### U", "usher": "### Us"}}])
def test_templates_that_could_not_be_read_back(bad):
    with pytest.raises(ValueError):
        chat.Template(**bad)


def rows():
    rnd = random.Random(4)
    out = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 5, "assistant", "first"), (2, 6, "user", "late"), (3, None, None, "no role"),
           (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 1, "assistant", "tie"), (None, 1, "assistant", "b"), (None, 0, "user", "a"),
           (4, 0, "system", "s"), (4, 1, "user", "u"), (5, 0, "tool", "</turn>"), (6, 0, "user", queries.TRAP * 20_000)]
    for i in range(3000):  # one conversation that holds most rows
        out.append((7, i, ("user", "assistant")[i % 2], "".join(rnd.choices(BITS, k=rnd.randint(0, 9)))))
    for c in range(20, 60):
        for i in range(rnd.randint(1, 6)):
            out.append((c, i, rnd.choice(["system", "user", "assistant", "user"]), "".join(rnd.choices(BITS, k=5))))
    return out


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for c, turns in convs.items():
        turns.sort()
        state, ok, chars = "start", True, 0
        for _, _, r, x in turns:
            state = {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"},
                     "assistant": {"user": "user"}}.get(state, {}).get(r)
            ok = ok and state is not None
            chars += len(chat.DEFAULT.opened(r) + chat.DEFAULT.escaped(x) + chat.DEFAULT.closing)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss), chars, ok, state == "assistant"))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def table(spark):
    data = rows()
    random.Random(1).shuffle(data)
    return spark.createDataFrame([(*r, 1, "p", "i", "s") for r in data], SCHEMA).repartition(4)


def test_digests(table):
    got = chat.read_back(chat.formatted(chat.segments(table)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows())


def test_segments_and_spans(table):
    found = chat.segments(table.where("conv_id < 7")).collect()
    for r in found:
        assert [s.loss for s in r.segments] == [False, r.role == "assistant", False]
    pieces = chat.formatted(chat.segments(table.where("conv_id < 7"))).collect()
    assert [r.piece for r in pieces] == ["".join(s.text for s in r.segments) for r in found]
    for r, f in zip(pieces, found, strict=True):
        assert [r.piece[s.start:s.end] for s in r.loss_spans] == [s.text for s in f.segments if s.loss]
    states = {c: [(r.state, r.allowed) for r in found if r.conv_id == c] for c in (1, 2, 4)}
    assert states == {1: [("user", True), ("assistant", True)], 2: [(None, False), (None, False)], 4: [("system", True), ("user", True)]}


def test_batches_cut_conversations_anywhere(spark, table):
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = chat.read_back(chat.formatted(chat.segments(table)))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.formatted(chat.segments(empty))).collect() == []
