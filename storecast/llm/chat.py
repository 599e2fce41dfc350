"""Chat formatting with a grammar round trip, in DataFrame functions only.

Template of a conversation::

    <s>[INST:role] text [/INST][INST:role] text [/INST]</s>

The grammar is deterministic: a turn ends at the first `` [/INST]``, its role at
the first ``] ``, and no control string may stand inside a role or a text.
Every turn is first rendered as it is, reparsed and compared to its source;
a turn that does not come back identical is escaped (``~`` and a digit for every
control string, ``~0`` for ``~``).  Then the whole conversation is reparsed and
compared; one that differs still is escaped in all its turns.  ``identical``
tells the result of the last comparison.

The loss mask is kept as runs: ``segments`` are the pieces of the formatted
text in order, ``loss`` marks those that are trained on (the texts of the
assistant), nothing else is under it.

Turns come in the order of (turn, role, text).  A conversation is put together
from blocks of turns, so the rendering and comparing of a very long one is
shared by many tasks; only its final text, one value by contract, is in one.

Edge cases: a null role or text is empty; rows with equal turn numbers, also
repeated rows, are turns of their own; rows with a null conv_id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import materialize
from storecast.llm.quality import let

# The control strings of the template and their escapes.
ESCAPES = {"~": "~0", "[/INST]": "~1", "[INST:": "~2", "[INST]": "~3", "</s>": "~4", "<s>": "~5"}
ROLE_ESCAPES = {**ESCAPES, "]": "~6", "[": "~7"}
CONTROL = r"\[/INST\]|\[INST[:\]]|</?s>"
BEGIN, OPEN, MID, END, FINISH = "<s>", "[INST:", "] ", " [/INST]", "</s>"
TURNS = "array<struct<role:string,text:string>>"


def escape(x: Column, escapes: dict[str, str] = ESCAPES) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), escapes.items(), x)


def unescape(x: Column) -> Column:
    plain = reduce(lambda c, kv: F.replace(c, F.lit(kv[1]), F.lit(kv[0])), reversed(ROLE_ESCAPES.items()), x)
    return F.when(F.contains(x, F.lit("~")), plain).otherwise(x)


def head(role: Column, escaped: Column) -> Column:
    return F.concat(F.lit(OPEN), F.when(escaped, escape(role, ROLE_ESCAPES)).otherwise(role), F.lit(MID))


def body(text: Column, escaped: Column) -> Column:
    return F.when(escaped, escape(text)).otherwise(text)


def render(turns: Column, escaped) -> Column:
    """The formatted conversation of an array of (role, text, ...) structs."""
    return F.concat(F.lit(BEGIN), F.array_join(F.transform(turns, lambda t: F.concat(
        head(t["role"], escaped(t)), body(t["text"], escaped(t)), F.lit(END))), ""), F.lit(FINISH))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, null where it breaks the grammar."""
    inner = F.substring(formatted, len(BEGIN) + 1, F.length(formatted) - len(BEGIN) - len(FINISH))
    parts = F.split(inner, r" \[/INST\]")

    def turn(part: Column) -> Column:
        rest = F.substring(part, len(OPEN) + 1, F.length(part))
        return let(F.struct(rest.alias("rest"), F.locate(MID, rest).alias("at")), lambda p: F.when(
            F.startswith(part, F.lit(OPEN)) & (p["at"] > 0) & ~F.rlike(p["rest"], F.lit(CONTROL)),
            F.struct(unescape(F.substring(p["rest"], 1, p["at"] - 1)).alias("role"),
                     unescape(F.substring(p["rest"], p["at"] + len(MID), F.length(p["rest"]))).alias("text"))))

    turns = let(parts, lambda p: F.when(
        F.element_at(p, -1) == "", F.transform(F.slice(p, 1, F.size(p) - 1), turn)))
    whole = F.startswith(formatted, F.lit(BEGIN)) & F.endswith(formatted, F.lit(FINISH))
    return F.when(whole, let(turns, lambda t: F.when(~F.exists(t, lambda x: x.isNull()), t)))


def format_chats(rows: DataFrame, loss_role: str = "assistant", block: int = 256) -> DataFrame:
    """conv_id, formatted, segments (text, loss) and identical, one row a conversation."""
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    one = F.array(F.struct("role", "text"))
    back = parse(render(one, lambda t: F.lit(False)))
    turns = turns.withColumn("escaped", ~F.coalesce(back == one, F.lit(False)))
    blocks = turns.groupBy("conv_id", F.floor(F.col("turn") / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "escaped"))).alias("turns"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "turns"))).alias("blocks")) \
        .select("conv_id", F.flatten(F.transform("blocks", lambda b: b["turns"])).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = whole.select("*", render(F.col("turns"), lambda t: t["escaped"]).alias("formatted"))
    first = first.withColumn("identical", F.coalesce(parse(F.col("formatted")) == source, F.lit(False)))
    turns = F.when(F.col("identical"), F.col("turns")).otherwise(F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text"), F.lit(True).alias("escaped"))))
    done = first.select("conv_id", turns.alias("turns"), F.when(F.col("identical"), F.col("formatted")).otherwise(
        render(F.col("turns"), lambda t: F.lit(True))).alias("formatted"), F.col("identical").alias("first_time"))
    none = F.lit(False)
    pieces = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(head(t["role"], t["escaped"]).alias("text"), none.alias("loss")),
        F.struct(body(t["text"], t["escaped"]).alias("text"), (t["role"] == loss_role).alias("loss")),
        F.struct(F.lit(END).alias("text"), none.alias("loss")))))
    edge = [F.array(F.struct(F.lit(x).alias("text"), none.alias("loss"))) for x in (BEGIN, FINISH)]
    return done.select("conv_id", "formatted", F.concat(edge[0], pieces, edge[1]).alias("segments"), (
        F.col("first_time") | F.coalesce(parse(F.col("formatted")) == source, none)).alias("identical"))


def digest(chats: DataFrame) -> DataFrame:
    """Counts and digests, read from formatted conversations alone."""
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = chats.select("conv_id", parse(F.col("formatted")).alias("turns"), F.array_join(loss, "").alias("loss"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def round_trip(rows: DataFrame) -> DataFrame:
    return digest(materialize(format_chats(rows), "chat"))


#: The conversation that the contract adds.
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def _sql_escape(x: str, escapes: dict[str, str]) -> str:
    return reduce(lambda c, kv: f"replace({c}, '{kv[0]}', '{kv[1]}')", escapes.items(), x)


SQL = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values {', '.join(map(str, EXTRA))}) v(conv_id, turn, role, text)),
e as (
  select *, regexp_matches(role || chr(10) || text, '\[/INST\]|\[INST[:\]]|</?s>|~[0-7]')
    or contains(role, '] ') or regexp_matches(role, '\[/?INST$') as esc
  from t)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       sum(case when role = 'assistant' then len(text) else 0 end)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
                       filter (role = 'assistant'), '')) as loss_sha256,
       (7 + sum({len(OPEN + MID + END)} + case when esc
          then len({_sql_escape('role', ROLE_ESCAPES)}) + len({_sql_escape('text', ESCAPES)})
          else len(role) + len(text) end))::bigint as formatted_chars
from e group by conv_id
"""
