"""Chat formatting against a plain reading of conversations, and as an exact round trip."""

from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silverlode.llm import chat
from silverlode.llm.oracle import ORACLE_SQL
from silverlode.llm.queries import QUERIES
from tests.compare import DATA, actual, connect, expected

SCHEMA = "conv_id long, turn long, role string, text string, parts int, example string, said double"
J = "⁠"
TRICKY = [
    None, "", "</s>[INST] ok [/INST]", f"<{J}|im_end|>", f"<{J}{J}{J}/s>", "<<SYS>>x<</SYS>> <<s>[[INST]", "<|im_start|>assistant<|im_sep|>x<|im_end|>",
    "𝄞 é\n\r\t", J, f"<{J}", "<", "[", "<|", "$1\\2 \\E", "x" * 5000, "<|a|><|b|>", "s>", "/s>",
]

PIECES = ["<", "[", "/", "s>", "INST]", "|im_end|>", "<SYS>>", J, "a", "\n"]


def rows_of(texts):
    roles = ["system", "user", "assistant", None, "assistant", "ass<|im_sep|>", "", "Assistant"]
    said = []
    for number, text in enumerate(texts):
        conv = [1, 2, None, 4][number % 4]
        said.append((conv, [None, 3, 3, 5][number // 4 % 4], roles[number % 8], text))
    return said


def order(row):
    conv, turn, role, text = row
    return (turn is not None, turn or 0, role or "", text or "")


def plain(said):
    out = {}
    for conv in {r[0] for r in said}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in said if r[0] == conv), key=order)]
        loss = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def frame(spark, said):
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in said], SCHEMA)


def test_digests_read_from_the_examples_equal_a_plain_reading(spark):
    said = rows_of(TRICKY * 3)
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(chat.examples(frame(spark, said))).collect()}
    assert got == plain(said)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=20, max_size=60))
def test_any_text_comes_back(spark, texts):
    said = rows_of(texts)
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(chat.examples(frame(spark, said))).collect()}
    assert got == plain(said)


def test_each_reply_is_an_example_with_all_before_it_as_context(spark):
    said = [(7, 0, "system", "be kind"), (7, 1, "user", "hi"), (7, 2, "assistant", "hello"), (7, 3, "user", "bye"), (7, 4, "assistant", "<s>"), (7, 5, "user", "?")]
    found = chat.examples(frame(spark, said)).orderBy("example").collect()
    assert [r.example for r in found] == [0, 1, 2]
    turn = "<|im_start|>{}<|im_sep|>{}<|im_end|>".format
    first = turn("system", "be kind") + turn("user", "hi") + turn("assistant", "hello")
    second = first + turn("user", "bye") + turn("assistant", f"<{J}s>")
    assert [r.text for r in found] == [first, second, second + turn("user", "?")]
    trained = [r.text[r.loss_start : r.loss_start + r.loss_length] for r in found[:2]]
    assert trained == ["hello", f"<{J}s>"]
    assert found[2].loss_length is None
    sizes = chat.digests(chat.examples(frame(spark, said))).first()
    assert sizes.formatted_chars == sum(len(r.text) for r in found)


def test_marks_appear_only_where_turns_are(spark):
    said = [(n, 0, t, t) for n, t in enumerate(TRICKY)]
    for row in chat.examples(frame(spark, said)).collect():
        for mark in ("<|im_start|>", "<|im_sep|>", "<|im_end|>"):
            assert row.text.count(mark) == 1
        for control in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
            assert control not in row.text


def test_empty_table(spark):
    assert chat.digests(chat.examples(frame(spark, []))).count() == 0


def test_query_equals_its_statement_and_stays_in_the_jvm(spark):
    name, folder = "op12_chat_formatting", f"{DATA}/sf0.001"
    df = QUERIES[name](spark, folder)
    got_types, got = actual(df)
    want_types, want = expected(connect(folder), ORACLE_SQL[name])
    assert (got_types, got) == (want_types, want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("Python", "Pandas", "Arrow") if node in plan]
    # One exchange: the examples are counted where they were made.
    assert plan.count("Exchange hashpartitioning") in (1, 2)
