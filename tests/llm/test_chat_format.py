import hashlib
import json

from hypothesis import given, settings, strategies as st

from tallyloom.llm import chat_format as chat

NASTY = ["\\### Assistant: </turn> ok", "</turn>", "<turn user>\nhi</turn>\n", "\\", "\\\\</turn>\\", "</turn", ">", "\n", "", "\\</turn>\\\\<turn ", "é中\U0001f600</turn>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(conv, turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from([*NASTY, "user", "assistant"]), st.text("<turn>\\/ \n\x00é", max_size=12)), st.one_of(st.sampled_from(NASTY), st.text("<turn>\\/ \n\x00é", max_size=30))), max_size=6))
def test_template_is_reversible(turns):
    pieces = [chat.TEMPLATE.turn(r, t) for r, t in turns]
    assert chat.TEMPLATE.turns("".join(p for p, _, _ in pieces)) == turns
    assert [chat.TEMPLATE.plain(p[a:b]) for p, a, b in pieces] == [t for _, t in turns]


def test_long_texts_take_linear_time():
    text = "\\" * 300_000 + "</turn>" * 100_000 + "x" * 1_000_000
    piece, _, _ = chat.TEMPLATE.turn("user", text)
    assert chat.TEMPLATE.turns(piece) == [("user", text)]


def test_layouts_become_the_same_turns(spark):
    said = [("system", "be brief"), ("user", "one\n\ntwo"), ("assistant", "ok </turn>")]
    layouts = {
        "messages": {"messages": [{"role": r, "content": t} for r, t in said]},
        "message_parts": {"messages": [{"role": r, "content": [{"type": "text", "text": t[:3]}, {"type": "text", "text": t[3:]}]} for r, t in said]},
        "from_value": {"conversations": [{"value": t, "from": {"user": "human", "assistant": "gpt"}.get(r, r)} for r, t in said]},
        "prompt_completion": {"completion": "ok </turn>", "prompt": "one\n\ntwo", "system": "be brief"},
        "prompt_response": {"system": "be brief", "response": "ok </turn>", "prompt": "one\n\ntwo"},
        "instruction": {"system": "be brief", "instruction": "one", "input": "two", "output": "ok </turn>"},
        "question_answer": {"system": "be brief", "context": "one", "question": "two", "answer": "ok </turn>"},
    }
    unknown = [None, "", "{broken", "[1, 2]", "7", json.dumps({"messages": [{"role": "user", "body": "x"}]}), json.dumps({"a.b": 1}), "[" * 5000, json.dumps({"prompt": "x"})]
    records = [(i, json.dumps(v), "n") for i, v in enumerate(layouts.values())] + [(100 + i, v, "n") for i, v in enumerate(unknown)]
    turns = chat.canonical_turns(spark.createDataFrame(records, "key long, record string, text string"), id_col="key")
    rows = turns.orderBy("conv_id", "turn", "part").collect()
    for i, name in enumerate(layouts):
        mine = [r for r in rows if r.conv_id == i]
        assert [(r.role, r.text) for r in mine] == said and {r.layout for r in mine} == {name}
    lost = [r for r in rows if r.layout is None]
    assert [r.conv_id for r in lost] == [100 + i for i in range(len(unknown))]
    assert [r.fingerprint is None for r in lost] == [True, True, True, False, False, False, False, True, False]
    read = chat.read_turns(chat.format_chats(turns)).orderBy("conv_id", "chunk", "place").collect()
    assert [(r.role, r.text) for r in read] == said * len(layouts)


def test_fingerprints_follow_paths_alone():
    a = {"b": [{"x": 1, "y": None}, {"x": "s"}], "a": {"c": 1}}
    b = {"a": {"c": [][:0] or "t"}, "b": [{"y": 2}, {"x": {}}, {}][:2]}
    assert chat.field_paths(a) == {"b[].x", "b[].y", "a.c"} == chat.field_paths(b)
    assert chat.field_paths({"a.b": 1}) != chat.field_paths({"a": {"b": 1}})
    assert chat.turns_of({"messages": []}, chat.compiled(chat.MAPPINGS)[chat.fingerprint(frozenset(chat.field_paths({"messages": []})))]) == []


def expected(rows):
    groups, out = {}, []
    for conv, turn, role, text in rows:
        if conv is None:
            out.append(digest(None, [(role or "", text or "")]))
        else:
            groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return sorted([*out, *(digest(c, [t[2:] for t in sorted(g)]) for c, g in groups.items())], key=repr)


def formatted(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, record string, own int")
    return chat.format_chats(chat.canonical_turns(chat.row_records(df)), **more)


def digests(df):
    return sorted((tuple(r)[:5] for r in chat.chat_digests(df).collect()), key=repr)


def test_rows_with_nulls_ties_repeats_and_marks(spark):
    rows = [(1, 0, "user", t) for t in NASTY] + [(1, 1, "assistant", t) for t in NASTY] + [(1, 1, "assistant", "ok"), (1, 1, "assistant", "ok")]
    rows += [(2, None, "assistant", None), (2, 3, None, "x"), (2, -1, "", ""), (3, 0, "assistant", "y" * 100_000), (4, 0, "a\n>b\\", "z")]
    rows += [(None, 0, "user", "lost"), (None, 0, "user", "lost"), (None, None, None, None)]
    assert digests(formatted(spark, rows)) == expected(rows)
    assert digests(formatted(spark, [])) == []


def test_long_conversation_is_written_in_chunks(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} </turn>") for i in range(3000)] + [(8, 0, "user", "x")]
    df = formatted(spark, rows, chunk_chars=1000)
    assert df.filter("conv_id = 7").count() > 50 and df.agg({"text": "max"}).count() == 1
    assert max(len(r.text) for r in df.collect()) <= 1000
    assert digests(df) == expected(rows)


def test_registered_query_against_sql(spark, sf):
    from compare import compare, connect
    from tallyloom.llm.queries import QUERIES, SQL

    assert compare(spark, connect(sf), sf, QUERIES["op11_chat_formatting"], SQL["op11_chat_formatting"]) is None
    row = QUERIES["op11_chat_formatting"](spark, sf).filter("conv_id = -7").first()
    assert tuple(row)[:5] == digest(-7, [("user", NASTY[0]), ("assistant", NASTY[0])])
