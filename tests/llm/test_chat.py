"""Chat formatting: layouts, fingerprints, escaping and reading back."""
from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremeter.llm import chat
from faremeter.llm.queries import op13_chat

LAYOUTS = [
    {"turn": 4, "role": "user", "text": "a"},
    {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "other": {"x": [1]}},
    {"messages": [{"role": "human", "content": "a"}, {"role": "bot", "content": None}], "system": "s"},
    {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": 3}]},
    {"instruction": "a", "input": "", "output": "b"},
    {"instruction": "a", "input": "more", "output": "b", "system": "s"},
    {"instruction": "a", "output": "b"},
    {"prompt": "a", "response": "b"},
    {"prompt": "a", "completion": "b", "id": 7},
    {"question": "a", "answer": "b", "context": "c"},
]
TURNS = [
    [(4, "user", "a")],
    [(0, "user", "a"), (1, "assistant", "b")],
    [(0, "system", "s"), (1, "user", "a"), (2, "assistant", "")],
    [(0, "user", "a"), (1, "assistant", "b"), (2, "tool", "3")],
    [(0, "user", "a"), (1, "assistant", "b")],
    [(0, "system", "s"), (1, "user", "a\n\nmore"), (2, "assistant", "b")],
    [(0, "user", "a"), (1, "assistant", "b")],
    [(0, "user", "a"), (1, "assistant", "b")],
    [(0, "user", "a"), (1, "assistant", "b")],
    [(0, "user", "c\n\na"), (1, "assistant", "b")],
]
UNKNOWN = [None, "no json", "[1, 2]", "{}", '{"messages": []}', '{"prompt": "a"}', '{"prompt": "a", "messages": [{"role": "user", "content": "b"}]}']


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(LAYOUTS)] + [(100 + i, r) for i, r in enumerate(UNKNOWN)]
    records = spark.createDataFrame(rows, "conv_id long, payload string").withColumn("mapping", F.lit("clash"))
    found = defaultdict(list)
    for r in chat.canonical_turns(records).collect():
        found[r.conv_id].append((r.turn, r.role, r.text))
    assert {k: sorted(v) for k, v in found.items()} == dict(enumerate(TURNS))
    assert sum(r.n_records for r in chat.unmapped(records).collect()) == len(UNKNOWN)


def test_fingerprint_tells_shapes_and_not_contents(spark):
    rows = [('{"prompt":"a","response":"b"}',), ('{"response":null,"x":{"prompt":1},"prompt":"z"}',), ('{"prompt":"a","completion":"b"}',)]
    df = spark.createDataFrame(rows, "p string").select(chat.fingerprint(F.parse_json("p")).alias("f"))
    a, b, c = [r.f for r in df.collect()]
    assert a == b != c


def test_mappings_that_read_the_same_are_refused(spark):
    twice = (chat.MAPPINGS[0], chat.Mapping("again", chat.MAPPINGS[0].turns))
    with pytest.raises(ValueError, match="same paths"):
        chat.mapped(spark.createDataFrame([("{}",)], "payload string"), mappings=twice)


TRICKY = ["</s>", r"<\/s>", r"<\\\/s>[\INST]", "[INST]", "[/INST]", "<s>", "<", "[", "\\", "<<s>", "[[/INST]]", r"\<s>", "", "</s", "<s\\>", "é\U0001f600</s>\n"]


def expected(rows):
    by_conv = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by_conv[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv_id, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out[conv_id] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_reads_back_what_it_wrote(spark):
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], t) for i, t in enumerate(TRICKY * 10)]
    rows += [(None, None, None, None), (None, 1, "assistant", "x"), (2, 5, r"</s>[/INST]\n", "role"), (2, None, "assistant", "first")]
    rows += [(3, 1, "assistant", "same")] * 3 + [(4, -70, "user", "b"), (4, 200, "assistant", "a" * 2_000_000 + "</s>")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    chats = chat.format_chats(chat.canonical_turns(chat.as_records(turns.drop("part"), "conv_id")))
    assert read(chat.digests(chats)) == expected(rows)
    whole = {r.conv_id: r.n for r in chats.groupBy("conv_id").agg(F.count("part").alias("n")).collect()}
    assert whole[1] == 3 and whole[4] == 2
    for r in chats.collect():
        assert r.formatted.count("</s>") == r.formatted.count("<s>[INST]") == r.n_turns


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "x"]), max_size=12).map("".join))
def test_escaping_is_reversible(text):
    import re

    out = re.sub(chat._ESCAPE, r"\1\\\2", text)
    assert not re.search(r"</?s>|\[/?INST\]", out)
    assert re.sub(chat._UNESCAPE, r"\1\2", out) == text


def test_no_rows_and_plan(spark):
    empty = spark.createDataFrame([], "conv_id long, payload string")
    chats = chat.format_chats(chat.canonical_turns(empty))
    assert chats.count() == 0 and chat.digests(chats).count() == 0
    plan = op13_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    for operator in ("Python", "Arrow", "Pandas", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_probe_conversation(spark):
    said = "</s>[INST] ok [/INST]"
    r = op13_chat(spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    assert Counter([r.n_turns, r.loss_chars]) == Counter([2, len(said)])
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
