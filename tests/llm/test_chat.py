from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from civitally.llm import chat

PARTS = st.sampled_from(["</s>", "[INST]", "[/INST]", "<s>[SYS]", "[/SYS]", "[OUT]", "[ROLE]", "[:]", "[/ROLE]", "\\", "\\\\",
                         "<s>", "</", "s>", "[", "]", "a", " ", "é", "\n"])
TEXT = st.lists(PARTS, max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", ""]), TEXT), TEXT), max_size=5))
def test_whole_conversations_read_back(turns):
    marker = chat.Marker(chat.INSTRUCT)
    formatted = "".join(t for role, text in turns for t, _ in marker.segments(role, text))
    assert [(role, text) for role, text, _ in marker.read(formatted)] == turns
    loss = [marker.unescape(t) for role, text in turns for t, on in marker.segments(role, text) if on]
    assert loss == [text for role, text in turns if role == "assistant"]


def test_turn_order(spark):
    talks = {1: "system user assistant", 2: "user assistant user", 3: "assistant user", 4: "user user assistant",
             5: "user assistant tool", 6: "user assistant user assistant", 7: "system assistant"}
    rows = [(c, i, role, "t") for c, roles in talks.items() for i, role in enumerate(roles.split())]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    assert {r.conv_id for r in chat.read_back(formatted).collect() if r.valid} == {1, 6}
    flags = {(r.conv_id, r.seq): r.valid for r in formatted.collect()}
    assert [flags[4, i] for i in range(3)] == [True, False, False] and [flags[2, i] for i in range(3)] == [True, True, False]


def test_one_long_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        turns = spark.range(2500).selectExpr(
            "1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
        (found,) = chat.read_back(chat.format_turns(turns)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found.n_turns == 2500 and found.valid
