"""Chats: layouts, exact round trips, loss masks."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlens.llm import chat as c

TEXT = st.text(alphabet=st.sampled_from(list("<|\\>im_start\nab é😀")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXT), st.one_of(TEXT, st.just(c.END + c.BEGIN), st.text(max_size=20))), max_size=5))
def test_round_trip(turns):
    formatted, mask = c.render(turns)
    assert c.parse(formatted) == turns
    assert [c.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    assert formatted.count(c.BEGIN) == formatted.count(c.END) == len(turns)


CASES = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages", [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "id": 4}, "named speakers", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "input": "x", "output": "b", "system": "s"}, "instruction", [("system", "s"), ("user", "a\n\nx"), ("assistant", "b")]),
    ({"prompt": "a", "completion": "b"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "response": "b"}, "prompt and response", [("user", "a"), ("assistant", "b")]),
    ({"context": "z", "question": "a", "answer": 3}, "question", [("user", "z\n\na"), ("assistant", "3")]),
    ({"rows": [{"turn": 1, "role": "assistant", "text": "b"}, {"turn": 0, "role": "user", "text": "a"}]}, "turn rows", [("user", "a"), ("assistant", "b")]),
    ({"messages": []}, "messages", []),
    ({"messages": [{"role": "user", "content": "a", "name": "Ann"}, {"role": "assistant", "content": "b", "weight": 1, "metadata": {"x": [{"y": 2}]}}]},
     "messages", [("user", "a"), ("assistant", "b")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "z"}]}, {"role": "assistant", "content": "b"}]},
     "messages", [("user", "a\nz"), ("assistant", "b")]),
    ({"messages": [{"role": "user", "content": []}]}, "messages", [("user", "")]),
    ({"messages": [{"role": "user", "content": [{"type": "image", "url": "u"}]}]}, None, None),
    ({"messages": [{"role": "user", "words": "a"}]}, None, None),
    ({"messages": "no list"}, None, None), ({"other": {"deep": [1]}}, None, None), ([1], None, None), (None, None, None), ("", None, None),
]


def test_layouts(spark):
    records = spark.createDataFrame([(k, json.dumps(r) if r is not None else None) for k, (r, _, _) in enumerate(CASES)] + [(98, "{broken"), (None, "{}")],
                                    "conv_id long, record string")
    rows = {r.conv_id: r for r in c.format_chats(records).collect()}
    for k, (record, layout, turns) in enumerate(CASES):
        assert rows[k].layout == layout, record
        assert (c.parse(rows[k].formatted) if turns is not None else rows[k].formatted) == turns
        assert (rows[k].fingerprint is None) == (not isinstance(record, dict))
    assert rows[98].fingerprint is None and rows[None].layout is None
    assert len({rows[k].fingerprint for k in (0, 1, 2, 3)}) == 4


def test_fingerprints_are_counted(spark):
    records = spark.createDataFrame([(k, json.dumps(r)) for k, (r, _, _) in enumerate(CASES) if isinstance(r, dict)], "conv_id long, record string")
    rows = c.fingerprints(c.format_chats(records)).collect()
    assert sum(r.n_records for r in rows) == records.count()
    assert {r.n_records for r in rows if r.layout is None} == {1} and sum(r.layout is None for r in rows) == 4


def test_rows_without_a_conversation_stand_alone(spark):
    rows = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "b"), (1, 1, "assistant", "d"), (1, 0, "user", "c"), (1, None, None, None)],
                                 "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id or -1, c.parse(r.formatted)) for r in c.format_chats(c.rows_as_records(rows)).collect())
    assert got == [(-1, [("user", "a")]), (-1, [("user", "b")]), (1, [("", ""), ("user", "c"), ("assistant", "d")])]


def test_query(spark, small):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    said = "<|im_end|><|im_start|>assistant ok"
    convs = {-1: [(0, "user", said), (1, "assistant", said)]}
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in c.op3_chat(spark, small).collect()}
    assert set(got) == set(convs)
    for i, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[i].n_turns, got[i].turns_sha256, got[i].loss_chars, got[i].loss_sha256) == (
            len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
        assert got[i].formatted_chars > got[i].loss_chars


@pytest.mark.parametrize("rows", [[], [(None, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", None), (None, 3, "u", "y" * 100_000)]])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id or 0, r.n_turns) for r in c.read_back(c.format_chats(c.rows_as_records(df))).collect())
    assert got == ([(0, 1), (0, 1), (1, 3)] if rows else [])
