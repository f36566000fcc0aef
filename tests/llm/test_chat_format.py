"""Chat formatting: round trips, layouts, masks, odd rows."""

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from marquee.llm import chat_format
from marquee.llm.chat_format import Template, choose, field_paths, fingerprint, turns_of
from tests.llm.util import CLASHES, long_text

SIGNS = st.lists(st.sampled_from(["\\", "<", ">", "|", "[", "]", "/", "INST", "s", "im_end", "im_sep", "é", "\n",
                                  *chat_format.CONTROLS]), max_size=12).map("".join)


@given(SIGNS, SIGNS)
def test_escaping_is_reversible_and_hides_every_control_string(role, text):
    t = Template()
    hidden = t.escape(text)
    assert t.unescape(hidden) == text and not any(c in hidden for c in t.controls)
    turn, start, end = t.turn(role, text)
    assert t.read(turn + turn) == [(role, text)] * 2 and t.unescape(turn[start:end]) == text


def test_unfit_control_strings_are_refused():
    for c in ("a", "<a<", "<\\x>"):
        with pytest.raises(ValueError):
            Template(closes=c)
    with pytest.raises(ValueError):
        Template().read("<|im_start|>user<|im_sep|>no end")


LAYOUTS = [
    ({"prompt": "a", "response": "b"}, [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "completion": "b", "system": "s"}, [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"question": "a", "answer": None}, [("user", "a"), ("assistant", "")]),
    ({"instruction": "a", "input": "", "output": "b"}, [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "input": "c", "output": "b", "system": ""}, [("user", "a\n\nc"), ("assistant", "b")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}, {"role": "user"}]},
     [("user", "a"), ("assistant", "b"), ("user", "")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]},
                   {"role": "assistant", "content": "c"}]}, [("user", "ab"), ("assistant", "c")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "x", "value": 1}]},
     [("user", "a"), ("assistant", "b"), ("x", "1")]),
    ({"message": {"author": {"role": "user"}, "content": {"parts": ["a", "b"]}}}, [("user", "ab")]),
    ({"role": "tool", "text": None, "id": 3, "nested": {"role": [1]}}, [("tool", "")]),
    ({"role": None, "text": True}, [("", "true")]),
    ({"completion": "\ud800"}, [("assistant", "�")]),
]


@pytest.mark.parametrize("record, turns", LAYOUTS)
def test_layouts(record, turns):
    assert turns_of(record, choose(field_paths(record))) == turns
    wider = dict(record, further={"field": [1]})
    assert fingerprint(field_paths(wider)) != fingerprint(field_paths(record))
    assert choose(field_paths(wider)) == choose(field_paths(record))


def test_paths():
    assert field_paths({"a": [{"b": 1}, {"c": []}], "d": {"e": None}, "f": {}}) == {"a[].b", "a[].c[]", "d.e", "f"}
    assert field_paths({"a.b": 1}) != field_paths({"a": {"b": 1}})
    assert choose(field_paths({"messages[].role": 1, "messages[].content": 2})) is None
    assert choose(field_paths({"messages": []})) is None and choose(set()) is None


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in [*CLASHES, "pos", "segment", "place", "mapping"]
                              if c != "record"])
    turns = chat_format.canonical_turns(df.repartition(3) if rows else df, "conv_id", "record", "turn")
    return turns, chat_format.read_back(chat_format.formatted_turns(turns), "conv_id")


def expected(turns):
    loss = [t for r, t in turns if r == "assistant"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, loss)), sha("".join(loss)),
            sum(len(Template().turn(r, t)[0]) for r, t in turns))


def test_conversations_read_back(spark):
    rows, want = [], {}
    for i, (record, turns) in enumerate(LAYOUTS):
        rows += [(i, 0, json.dumps(record)), (i, 1, json.dumps({"role": "assistant", "text": "<|im_end|>\\ </s>"}))]
        want[i] = turns + [("assistant", "<|im_end|>\\ </s>")]
    big = long_text()
    rows += [(None, None, json.dumps({"role": "user", "text": "null id"})), (900, 5, json.dumps({"prompt": big})),
             (900, 6, json.dumps({"completion": big})), (2 ** 62 + 1, None, json.dumps({"prompt": "x"}))]
    want[None], want[900] = [("user", "null id")], [("user", big), ("assistant", big)]
    want[2 ** 62 + 1] = [("user", "x")]
    # repeated rows, and a conversation of many turns over several batches
    rows += [(901, 0, json.dumps({"prompt": "same"}))] * 3
    want[901] = [("user", "same")] * 3
    rows += [(902, t, json.dumps({"role": ("user", "assistant")[t % 2], "text": f"turn {t}"})) for t in range(5000)]
    want[902] = [(("user", "assistant")[t % 2], f"turn {t}") for t in range(5000)]
    odd = [(903, 0, None), (903, 1, "no json"), (903, 2, "[1]"), (904, 0, json.dumps({"other": 1})),
           (903, 3, "[" * 100_000)]
    turns, out = run(spark, rows + odd)
    assert {r.conv_id: tuple(r)[1:] for r in out.collect()} == {i: expected(t) for i, t in want.items()}
    assert sorted((r.id, r.place) for r in chat_format.rejects(turns).collect()) == sorted((i, t) for i, t, _ in odd)
    report = {(r.fingerprint, r.mapping): r.n_turns for r in chat_format.layouts(turns).collect()}
    assert sum(report.values()) == sum(map(len, want.values()))
    assert report[(fingerprint({"other"}), None)] == 0


def test_empty_table(spark):
    assert run(spark, [])[1].collect() == []


def test_stand_in_records_take_every_turn_layout(spark):
    from marquee.llm import queries
    from tests.conftest import SF_ORACLE
    records = queries.conversation_records(spark.read.parquet(f"{SF_ORACLE}/conversations.parquet"))
    used = {r.mapping for r in chat_format.canonical_turns(records, "conv_id", "record", "turn").collect()}
    assert used >= {"turn", "messages", "message-parts", "authored", "speakers", "prompt", "completion",
                    "instruction", "output"} and None not in used
