"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

Each participant of a conversation gets a rendering in which that speaker is the assistant and
the others are users with names; the mask marks what the assistant says. Messages of role
`system` are nobody's and stay as they are. A dialogue is rendered whole, or, where a number of
messages is given, in parts of so many: then no conversation, however long, meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Messages of a part in the registered query.
PART = 512
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def _placed(conversations: DataFrame, most: int) -> DataFrame:
    """(conv_id, role, text, part, at): the messages of each conversation in order, most in a part.

    The rows are sorted by ranges; a message's number is its place in its range, and the messages of the
    conversation in ranges before. So a long conversation is numbered in pieces.
    """
    scratch = Scratch(conversations.sparkSession, "chat")
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.rand(5).alias("_salt"))
    rows = scratch.save(rows.repartitionByRange(*order, "_salt").sortWithinPartitions(*order).drop("_salt").withColumn("id", F.monotonically_increasing_id()))
    rows = rows.withColumn("range", F.shiftright("id", 33))
    # as many rows as ranges and conversations together
    held = rows.groupBy("conv_id", "range").agg(F.min("id").alias("first"), F.count("*").alias("c"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col("conv_id").alias("conv_"), F.col("range").alias("range_"), (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    number = F.col("id") + F.col("shift")
    return rows.join(held, (F.col("range") == F.col("range_")) & F.col("conv_id").eqNullSafe(F.col("conv_"))).select(
        "conv_id", "role", "text", F.floor(number / F.lit(most)).cast("long").alias("part"), (number % F.lit(most)).cast("int").alias("at"))


def segments(conversations: DataFrame, most: int | None) -> DataFrame:
    """(conv_id, perspective, part, at, head, body, target): a row a message and perspective.

    Messages are ordered by turn, those of equal turns by role and text, nulls first. A conversation's
    first message, if it is the system's, also begins each later part.
    """
    if most is None:
        number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1
        rows = conversations.select("conv_id", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                                    F.lit(0).cast("long").alias("part"), number.alias("at"))
    else:
        rows = _placed(conversations, most)
        opening = rows.filter((F.col("part") == 0) & (F.col("at") == 0) & (F.col("role") == SYSTEM)).select(F.col("conv_id").alias("conv_"), "role", "text")
        later = rows.filter("part > 0").select("conv_id", "part").distinct()
        rows = rows.union(later.join(opening, F.col("conv_id").eqNullSafe(F.col("conv_"))).select("conv_id", "role", "text", "part", F.lit(-1).alias("at")))
    safe = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = rows.select("conv_id", "part", "at", F.coalesce("role", F.lit("")).alias("role"), safe.alias("text"))
    # system speaks for nobody; where there is no one else, one rendering has no perspective
    who = conversations.groupBy("conv_id", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("who")).agg(F.lit(1).alias("one"))
    others = F.count(F.when(F.col("who") != SYSTEM, 1)).over(Window.partitionBy("conv_id"))
    who = who.withColumn("others", others).filter((F.col("who") != SYSTEM) | (F.col("others") == 0)).select(
        F.col("conv_id").alias("conv_"), F.when(F.col("who") != SYSTEM, F.col("who")).alias("perspective"))
    both = rows.join(who, F.col("conv_id").eqNullSafe(F.col("conv_")))
    target = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    name = F.replace(F.replace("role", F.lit("<|"), F.lit("< |")), F.lit("\n"), F.lit(" "))
    head = F.when(F.col("role") == SYSTEM, F.lit(f"{START}{SYSTEM}\n")).when(target, F.lit(f"{START}assistant\n")).otherwise(
        F.concat(F.lit(f"{START}user name="), name, F.lit("\n")))
    return both.select("conv_id", "perspective", "part", "at", head.alias("head"), F.concat("text", F.lit(f"{END}\n")).alias("body"), target.alias("target"))


def rotated(conversations: DataFrame, most: int | None = None) -> DataFrame:
    """(conv_id, perspective, part, n_messages, text, mask, n_target).

    most: messages in a part; without it, dialogues are whole and part is 0. mask: "start-end" of each
    stretch of text, in characters, that the assistant says (its end mark included), comma-joined;
    n_target: their length. A null role is a participant without a name, null text is empty, null turns
    come first, a null conv_id is a conversation of its own; repeated rows are repeated messages. "<|"
    in texts becomes "< |", so they can't hold marks. Other columns are ignored, whatever their names.
    """
    parts = segments(conversations, most).groupBy("conv_id", "perspective", "part").agg(
        F.sort_array(F.collect_list(F.struct("at", "head", "body", "target"))).alias("s"))
    length = lambda x: F.length(x["head"]) + F.length(x["body"])
    span = lambda a, x: F.struct((a["end"] + F.length(x["head"])).alias("lo"), (a["end"] + length(x)).alias("hi"))
    first = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<lo:int,hi:int>>").alias("spans"))
    step = lambda a, x: F.struct((a["end"] + length(x)).alias("end"), F.when(
        x["target"], F.concat(a["spans"], F.array(span(a, x)))).otherwise(a["spans"]).alias("spans"))
    out = parts.withColumn("spans", F.aggregate("s", first, step, lambda a: a["spans"]))
    mask = F.transform("spans", lambda x: F.concat_ws("-", x["lo"].cast("string"), x["hi"].cast("string")))
    return out.select("conv_id", "perspective", "part", F.size("s").cast("long").alias("n_messages"),
                      F.array_join(F.transform("s", lambda x: F.concat(x["head"], x["body"])), "").alias("text"), F.array_join(mask, ",").alias("mask"),
                      F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["hi"] - x["lo"]).alias("n_target"))


def op7_chat(spark, sf_dir: str) -> DataFrame:
    return rotated(spark.read.parquet(f"{sf_dir}/conversations.parquet"), PART)


OP7_SQL = f"""
WITH m0 AS (SELECT conv_id, coalesce(role, '') AS role, replace(coalesce(text, ''), '<|', '< |') AS t,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS n
            FROM conversations),
m AS (SELECT conv_id, role, t, n // {PART} AS part, n % {PART} AS pos FROM m0 UNION ALL
      SELECT m0.conv_id, role, t, l.part, -1 FROM m0 JOIN (SELECT DISTINCT conv_id, n // {PART} AS part FROM m0 WHERE n >= {PART}) l
      ON m0.conv_id IS NOT DISTINCT FROM l.conv_id WHERE n = 0 AND role = '{SYSTEM}'),
r AS (SELECT DISTINCT conv_id, coalesce(role, '') AS who FROM conversations),
w AS (SELECT conv_id, who FROM r WHERE who <> '{SYSTEM}' UNION ALL
      SELECT conv_id, NULL FROM r GROUP BY conv_id HAVING bool_and(who = '{SYSTEM}')),
s AS (SELECT m.conv_id, who, CAST(part AS BIGINT) AS part, pos, coalesce(role = who, false) AS target,
             CASE WHEN role = '{SYSTEM}' THEN '{START}{SYSTEM}' || chr(10) WHEN role = who THEN '{START}assistant' || chr(10)
                  ELSE '{START}user name=' || replace(replace(role, '<|', '< |'), chr(10), ' ') || chr(10) END AS head,
             t || '{END}' || chr(10) AS body
      FROM m JOIN w ON m.conv_id IS NOT DISTINCT FROM w.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, who, part ORDER BY pos) AS hi FROM s)
SELECT conv_id, who AS perspective, part, count(*) AS n_messages, string_agg(head || body, '' ORDER BY pos) AS text,
       coalesce(string_agg(CAST(CAST(hi - length(body) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(hi AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE target), '') AS mask,
       CAST(coalesce(sum(length(body)) FILTER (WHERE target), 0) AS BIGINT) AS n_target
FROM o GROUP BY conv_id, who, part
"""
