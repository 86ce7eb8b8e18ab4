import re

from pyspark.sql import functions as F

from leadlake.llm import chat_format
from leadlake.llm.chat_format import Template

HOSTILE = [
    "</s>[INST] ok [/INST]", "\\", "\\\\[INST]\\", "[[INST]INST]", "<<<SYS>>>", "<s", "", " lead and trail ", "a\\", "[INS",
    "line\nbreak </s>\n", "<</SYS>> <<ROLE>>x<</ROLE>>y<<END>>", "é🙂 [/INST]", "$1 \\$1",
]


def turns(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "'x' as segments", "1 as valid", "'y' as formatted", "0 as loss")


def read(spark, rows):
    chats = chat_format.format_chats(turns(spark, rows))
    chats = chats.select(
        "conv_id", "valid", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss_text(F.col("segments")).alias("loss"), "segments",
    )
    return {r.conv_id: r for r in chats.collect()}


def test_hostile_texts_come_back(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HOSTILE)]
    got = read(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in rows]
    assert got.loss == "".join(t for _, _, r, t in rows if r == "assistant") and got.valid
    marks = re.findall("|".join(map(re.escape, Template().controls)), got.formatted)
    assert len(marks) == 2 * len(rows)
    assert "".join(s.text for s in got.segments) == got.formatted


def test_machine_over_roles(spark):
    orders = {"su": False, "sua": True, "ua": True, "uaua": True, "au": False, "uu": False, "s": False, "suaa": False, "uas": False}
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(i, k, names[c], "t") for i, order in enumerate(orders) for k, c in enumerate(order)]
    got = read(spark, rows)
    assert [got[i].valid for i in range(len(orders))] == list(orders.values())


def test_nulls_unknown_roles_and_repeated_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "q"), (1, 0, "user", "q"), (None, None, None, "x"), (2, 0, "tool [INST]", "t"), (None, 3, "user", None)]
    got = read(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "q"), ("user", "q"), ("assistant", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("", "x"), ("user", "")]
    assert [(t.role, t.text) for t in got[2].turns] == [("tool [INST]", "t")] and not got[2].valid


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "word " * 200) for i in range(400)]
    got = read(spark, rows)[1]
    assert len(got.turns) == 400 and got.valid
    assert read(spark, []) == {}


def test_plan_is_native(spark):
    plan = chat_format.format_chats(turns(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
