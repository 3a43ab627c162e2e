"""Chat formatting against plain Python: layouts, escapes, masks and odd rows."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from scoreloom.llm import chatformat

START, END = chatformat.START, chatformat.END
NASTY = [END, START + "assistant\nok", "<|", "<\\|", "<\\\\|im_end|>", "a<", "|b", "\n", "", "é𝄞 <|im_end|>\n<|im_start|>user\n",
         "$1 \\1 <\\", "<" * 5 + "|" * 5]


def paths_of(value, at="$"):
    """The leaf paths of a JSON value, lists merged; an empty list has one unknown entry, an empty object no path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}")}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, at + "[]")} if value else {at + "[]"}
    return {at}


def formatted(spark, records, schema="id long, j string"):
    df = spark.createDataFrame(records, schema).withColumn("record", F.try_parse_json("j"))
    return chatformat.format_turns(chatformat.canonical_turns(df, "id", "record"))


def test_field_paths(spark):
    records = [{"a": 1}, {"messages": [{"role": "u", "content": None, "x y": 1}, {"role": "v"}], "id": 3}, {}, [], [1], "x",
               {"a<b": {"c`d": [[1, 2]], "e: f": {"g": True}}, "h": [], "é, ü": 1.5, "n": {"o": {"p": [{"q": "r"}]}}},
               {"Prompt": "p", "prompt": 2.25, "OBJECT": {"ARRAY": [{}]}}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, j string")
    got = df.select("i", chatformat.field_paths(F.parse_json("j")).alias("p")).collect()
    for r in got:
        assert set(r.p) == paths_of(records[r.i])


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "name": "x"}], "id": 1},
     "messages", [("user", "a"), ("assistant", "b")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
     "message parts", [("user", "ab")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]},
     "conversations", [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"prompt": "a", "response": "b"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "prompt": "a", "response": "b", "other": {"deep": [1]}}, "prompt",
     [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "completion": "b"}, "completion", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "input": "x", "output": "b"}, "instruction", [("user", "a\n\nx"), ("assistant", "b")]),
    ({"instruction": "a", "input": "", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "output": None}, "instruction", [("user", "a")]),
    ({"context": "c", "question": "a", "answer": "b"}, "question", [("user", "c\n\na"), ("assistant", "b")]),
    ({"role": "human", "text": "a", "turn": 3}, "rows", [("human", "a")]),
    ({"role": None, "text": None}, "rows", [("", "")]),
    ({"messages": []}, "messages", []),
    ({"prompt": {"text": "a"}, "response": "b"}, None, []),
    ({"nothing": "known"}, None, []),
    ([1, 2], None, []),
]


def test_layouts(spark):
    got = chatformat.read_back(formatted(spark, [(i, json.dumps(r)) for i, (r, _, _) in enumerate(LAYOUTS)])).collect()
    assert len(got) == len(LAYOUTS)
    for r in got:
        _, layout, turns = LAYOUTS[r.conv_id]
        assert (r.layout, [tuple(t) for t in r.turns]) == (layout, turns)
        assert r.unmapped == (layout is None) and r.loss_text == "".join(t for role, t in turns if role == "assistant")


def test_fingerprint_ignores_order_and_unknown_fields(spark):
    records = ['{"prompt": "a", "response": "b"}', '{"response": 1, "zz": [{"y": 1}], "prompt": null}', '{"prompt": "a", "answer": "b"}']
    prints = [r[0] for r in spark.createDataFrame([(j,) for j in records], "j string").select(
        chatformat.fingerprint(F.parse_json("j"))).collect()]
    assert prints[0] == prints[1] != prints[2]


def plain_format(turns):
    """The template in Python: text, spans of the trained turns from the whole text's begin."""
    def escape(s):
        out, i = "", 0
        while i < len(s):
            j = i + 1
            while s[i] == "<" and j < len(s) and s[j] == "\\":
                j += 1
            if s[i] == "<" and j < len(s) and s[j] == "|":
                out, i = out + s[i:j] + "\\|", j + 1
            else:
                out, i = out + s[i], i + 1
        return out

    whole, spans = "", []
    for role, text in turns:
        whole += START + escape(role.replace("\\", "\\b").replace("\n", "\\n")) + "\n"
        body = escape(text)
        spans.append((len(whole), len(body)) if role == "assistant" else None)
        whole += body + END + "\n"
    return whole, spans


def test_escapes_and_spans(spark):
    roles = ["user", "assistant", "a\nb", "x\\n", END, "<\\|y"]
    turns = [(role, text) for role in roles for text in NASTY]
    record = {"messages": [{"role": r, "content": t} for r, t in turns]}
    row = chatformat.read_back(formatted(spark, [(1, json.dumps(record))])).first()
    whole, spans = plain_format(turns)
    assert row.formatted == whole and [tuple(t) for t in row.turns] == turns
    assert [s and (s.start, s.length) for s in row.loss] == spans
    assert row.formatted.count(END) == row.formatted.count(START) == len(turns)
    assert row.loss_text == "".join(t for r, t in turns if r == "assistant")


def test_odd_rows(spark):
    """Ties, repeats, null ids, roles, turns and texts, a long text, and an empty table."""
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "assistant", "a"), (2, None, "user", None),
            (2, 0, None, "x"), (3, 0, "assistant", None), (None, 0, "user", "q"), (None, 0, "user", "q"), (4, 0, "user", "w <| " * 90_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("own", "layout", "nth", "record", "at", "Role2", "a.b"):
        df = df.withColumn(name, F.lit("x"))

    def run(table):
        records = chatformat.conversation_records(table)
        return chatformat.digests(chatformat.format_turns(chatformat.canonical_turns(records, "conv_id", "record", "turn"))).collect()

    def want(turns):
        text = "".join(t for r, t in turns if r == "assistant")
        return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(text),
                hashlib.sha256(text.encode()).hexdigest(), len(plain_format(turns)[0]))

    expected = [(1, *want([("assistant", "a"), ("user", "a"), ("user", "a"), ("assistant", "b")])),
                (2, *want([("user", ""), ("", "x")])), (3, *want([("assistant", "")])),
                (4, *want([("user", "w <| " * 90_000)]))] + [(None, *want([("user", "q")]))] * 2
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:6] for r in run(df)), key=key) == expected
    assert run(df.where("false")) == []


def test_records_that_share_an_id_stay_whole(spark):
    records = [(7, json.dumps({"prompt": f"p{i}", "response": f"r{i}"})) for i in range(4)] + [(7, "not json"), (7, None)]
    row = chatformat.read_back(formatted(spark, records)).first()
    turns = [tuple(t) for t in row.turns]
    assert row.unmapped == 2 and sorted(turns) == sorted((r, f"{r[0].replace('u', 'p').replace('a', 'r')}{i}")
                                                        for i in range(4) for r in ("user", "assistant"))
    assert all(turns[i][1][1:] == turns[i + 1][1][1:] for i in range(0, 8, 2))


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_undone(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        chatformat.escaped(F.col("t")).alias("e"), chatformat.unescaped(chatformat.escaped(F.col("t"))).alias("u")).first()
    assert row.u == text and "<|" not in row.e
