"""Chat formatting: event logs folded into final messages, then rendered (DataFrame functions only).

The log has one row per event: conv_id, turn, copy (tells apart messages of one turn),
seq, event, role, text.  ``start``, ``edit`` and ``regenerate`` begin the message's text
anew with their own text (null: empty), ``delta`` appends to it, ``delete`` takes the
message away; events of a message are folded in order of seq, so what the last of the
former kinds left behind never shows.  The role is the last one given.

A conversation is rendered in parts of ``part_turns`` turns (so that one of any length
is split over tasks; joined in order the parts are the conversation).  A turn is
``open role header text close``.  Inside roles and texts the escape character is
doubled, and set after the first character of every control string; taking away each
escape character's first occurrence restores them.  ``loss`` holds the spans (code
points of the part) of the texts of ``loss_roles``.

Edge cases: null texts and roles are empty; null turns come first; equal rows are separate
messages; a null conv_id is a conversation of its own; an empty log gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "[INST]"
    header: str = "[/INST]"
    close: str = "</s>"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    part_turns: int = 256

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.header, self.close)

    def __post_init__(self):
        if len(self.escape) != 1 or any(len(c) < 2 or self.escape in c for c in self.controls):
            raise ValueError("control strings need two characters or more, none of them the escape character")


def _literal(s: str) -> str:
    return "".join(f"\\{c}" if re.match(r"[^\w\s]", c) else c for c in s)


def escaped(text: Column, t: Template) -> Column:
    e = _literal(t.escape)
    doubled = F.regexp_replace(text, e, (e + e))
    return F.regexp_replace(doubled, "(?s)(?=" + "|".join(map(_literal, t.controls)) + ")(.)", "$1" + e)


def unescaped(text: Column, t: Template) -> Column:
    return F.regexp_replace(text, f"(?s){_literal(t.escape)}(.)", "$1")


def folded(log: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, role, text) of the final messages of an event log."""
    rows = log.groupBy("conv_id", "turn", "copy").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.sort_array(F.collect_list(F.struct("seq", "event", F.coalesce("text", F.lit("")).alias("text")))).alias("events"))
    # sorted by seq: everything before the last event that is no delta is void
    rows = rows.withColumn("at", F.expr("array_max(transform(events, (e, i) -> if(e.event = 'delta', 0, i)))"))
    kept = F.expr("slice(events, at + 1, size(events))")
    return rows.where("events[at].event <> 'delete'").select(
        "conv_id", "turn", "copy", F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"))


def rendered(messages: DataFrame, t: Template = Template()) -> DataFrame:
    """(conv_id, part, formatted, loss) in parts; loss: array<struct<start,end>> of code points."""
    role, text = escaped(F.col("role"), t), escaped(F.col("text"), t)
    head = F.concat(F.lit(t.open), role, F.lit(t.header))
    turns = messages.select(
        "conv_id", F.floor(F.col("turn") / t.part_turns).alias("part"), "turn", "copy",
        F.concat(head, text, F.lit(t.close)).alias("piece"), F.length(head).alias("head"), F.length(text).alias("len"),
        F.col("role").isin(list(t.loss_roles)).alias("learn"))
    parts = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "copy", "piece", "head", "len", "learn"))).alias("turns"))
    spans = F.expr(f"""
        aggregate(turns, struct(0 as pos, cast(array() as array<struct<start:int,end:int>>) as out),
                  (s, x) -> struct(s.pos + x.head + x.len + {len(t.close)} as pos,
                                   if(x.learn, concat(s.out, array(struct(s.pos + x.head as start, s.pos + x.head + x.len as end))), s.out) as out),
                  s -> s.out)""")
    return parts.select("conv_id", "part", F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss"))


def read_back(parts: DataFrame, t: Template = Template()) -> DataFrame:
    """(conv_id, part, turns: array<struct<role,text>>, learned: array<string>) parsed from rendered parts."""
    pieces = F.split("formatted", _literal(t.close))
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: F.split(x, _literal(t.header), 2))
    return parts.select(
        "conv_id", "part",
        F.transform(turns, lambda x: F.struct(unescaped(F.substring(x[0], F.lit(len(t.open) + 1), F.length(x[0])), t).alias("role"), unescaped(x[1], t).alias("text"))).alias("turns"),
        F.transform("loss", lambda x: unescaped(F.substring("formatted", x["start"] + 1, x["end"] - x["start"]), t)).alias("learned"),
        F.length("formatted").alias("chars"))


def as_log(conversations: DataFrame) -> DataFrame:
    """Rows by turn as an event log: each starts its message and streams its text as a delta."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "copy", F.row_number().over(W.partitionBy("conv_id", "turn").orderBy("role", "text")))
    event = F.explode(F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("start").alias("event"), F.col("role").alias("role"), F.lit("").alias("text")),
        F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("event"), F.lit(None).cast("string").alias("role"), F.col("text").alias("text"))))
    return rows.select("conv_id", "turn", "copy", event.alias("e")).select("conv_id", "turn", "copy", "e.*")


def digests(parts: DataFrame, t: Template = Template()) -> DataFrame:
    """One row per conversation, read back from its rendered parts."""
    back = read_back(parts, t)
    whole = back.select(
        "conv_id", "part", F.size("turns").cast("long").alias("n"), F.col("chars").cast("long").alias("chars"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("learned", "").alias("learned"))
    texts = whole.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sum(F.length("learned")).cast("long").alias("loss_chars"),
        F.sort_array(F.collect_list(F.struct("part", "said", "learned"))).alias("p"))
    digest = lambda name: F.sha2(F.array_join(F.transform("p", lambda x: x[name]), ""), 256)
    return texts.select("conv_id", "n_turns", digest("said").alias("turns_sha256"), "loss_chars", digest("learned").alias("loss_sha256"), "formatted_chars")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"select cast(-1 as bigint) conv_id, cast(i as bigint) turn, if(i = 0, 'user', 'assistant') role, '{said}' text from (select explode(array(0, 1)) i)")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(rendered(folded(as_log(rows))))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, length(regexp_replace(replace(text, '\', '\\'), '\[INST\]|\[/INST\]|</s>', '\0+', 'g'))
              + length(regexp_replace(replace(role, '\', '\\'), '\[INST\]|\[/INST\]|</s>', '\0+', 'g')) + 17 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
