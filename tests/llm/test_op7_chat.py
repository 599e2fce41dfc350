from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import chat, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"
DDL = "conv_id long, turn long, role string, text string, block string, formatted string, escaped string"


def convs(spark, turns):
    return spark.createDataFrame([(*t, "x", "x", "x") for t in turns], DDL)


NASTY = ["", " ", "~", "~0", "~1~2", "<s>", "</s>", "<s", "[/INST]", " [/INST]", " [/INST", "[INST:user] hi [/INST]",
         "[INST]", "] ", "]", "~[INST]~0", "[/INST[/INST]]", "<<s>/s>", "</s></s>", "\n", "é 日本 \U0001f600 </s>", None,
         "x" * 300_000, "[INST:" * 500]


def test_equals_sql(spark):
    got = queries.QUERIES["op7_chat_format"](spark, SF)
    assert rows(got) == duck_rows(chat.SQL, conversations=table(spark, SF, "conversations"))
    assert got.where("conv_id = -1").select("n_turns", "loss_chars").first() == (2, 21)


def test_round_trip_of_nasty_content(spark):
    turns = [(i, j, r, t) for i, t in enumerate(NASTY) for j, r in enumerate(("user", "assistant"))]
    turns += [(100 + i, 0, r, "hello") for i, r in enumerate(NASTY[:21])]
    turns += [(200, j, "user", t) for j, t in enumerate(NASTY)] + [(201, 0, "assistant", "a"), (201, 0, "assistant", "a")]
    turns += [(None, None, "user", "no id"), (202, None, "assistant", None)]
    df = convs(spark, turns)
    out = chat.format_chats(df).collect()
    assert all(r.identical for r in out) and len(out) == len({t[0] for t in turns})
    for r in out:
        assert "".join(s.text for s in r.segments) == r.formatted
        inner = "".join(s.text for s in r.segments if s.loss)
        assert not any(c in inner for c in ("[/INST]", "[INST:", "[INST]", "<s>", "</s>"))
    assert rows(chat.digest(chat.format_chats(df))) == duck_rows(chat.SQL.replace(
        "union all select * from (values", "union all select * from (select * from (values").replace(
        "v(conv_id, turn, role, text))", "v(conv_id, turn, role, text)) where false)"), conversations=df)


def test_blocks_do_not_change_the_result(spark):
    df = table(spark, SF, "conversations").withColumn("conv_id", F.col("conv_id") % 3)
    df = df.withColumn("turn", F.row_number().over(
        __import__("pyspark").sql.Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    a, b = (rows(chat.format_chats(df, block=n).select("conv_id", "formatted", "identical")) for n in (2, 10**6))
    assert a == b


def test_broken_text_is_refused(spark):
    bad = ["", "<s>", "<s></s", "<s>[INST:user] a</s>", "<s>[INST:user] a [/INST]b</s>", "<s>a [/INST]</s>",
           "<s>[INST:user] a </s> [/INST]</s>", "<s>[INST:user]a [/INST]</s>"]
    df = spark.createDataFrame([(b,) for b in bad + ["<s></s>"]], "f string")
    assert [r.t for r in df.select(chat.parse(F.col("f")).alias("t")).collect()] == [None] * len(bad) + [[]]


def test_empty(spark):
    assert chat.format_chats(convs(spark, [(1, 1, "user", "a")]).where(F.lit(False))).count() == 0
