"""Operator 5: chat formatting with cumulative-snapshot collapse.

Chat logs often hold a conversation several times, each snapshot longer than the one before.
A conversation whose turns all begin a longer conversation is dropped; of equal ones the least
id stays. The maximal ones are rendered in a chat template.

The hash of the first i turns is a running sum of 62-bit hashes of (i, role, text), twice with
different salts, so prefixes of different conversations compare by two numbers. Running sums
come in two levels (blocks of ``BLOCK`` turn numbers, then blocks of a conversation), so a long
conversation is not one window. An anti-join of whole conversations with the prefixes of
longer ones leaves the maximal ones; both sides are aggregated first, so thousands of equal
conversations or first turns are one row.

Defined cases: turns are ordered by turn number, then role and text; NULL turn numbers come
last; a NULL role or text is rendered as empty and differs from an empty one; turns without a
conversation id are conversations of one turn each (equal ones count as copies); repeated rows
are turns of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

BLOCK = 1024
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>"


def turn_hash(salt: str) -> Column:
    """62 bits of a turn at its position, as a decimal that can be summed."""
    field = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-"))
    role = field("role")
    content = F.concat(F.col("at").cast("string"), F.lit("|"), F.length(role).cast("string"), F.lit("|"), role, F.lit("|"), field("text"))
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.md5(content)), 2).cast("decimal(38,0)")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Every turn with its conversation key, its position from 0 and the prefix hashes up to it."""
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                     F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    own = F.when(F.col("conv_id").isNull(), F.concat(F.lit("n:"), F.col("row").cast("string"))).otherwise(
        F.concat(F.lit("k:"), F.col("conv_id").cast("string")))
    block = F.floor(F.col("turn") / BLOCK)
    t = materialize(t.withColumn("conv", own).withColumn("block", F.coalesce(block, F.lit((1 << 62))).cast("long")), "turns")
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("row")]
    inside = Window.partitionBy("conv", "block").orderBy(*order)
    blocks = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = t.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(blocks), F.lit(0)))
    t = t.withColumn("local", F.row_number().over(inside)).join(starts.select("conv", "block", "start"), ["conv", "block"])
    t = t.withColumn("at", (F.col("start") + F.col("local") - 1).cast("long")).drop("local", "start")
    t = t.withColumn("h1", turn_hash("a")).withColumn("h2", turn_hash("b"))
    upto = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = t.groupBy("conv", "block").agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select("conv", "block", *[F.coalesce(F.sum(s).over(blocks), zero).alias(s) for s in ("s1", "s2")])
    t = t.withColumn("p1", F.sum("h1").over(upto)).withColumn("p2", F.sum("h2").over(upto)).join(sums, ["conv", "block"])
    return t.select("conv", "conv_id", "row", "turn", "role", "text", "at", *[
        (F.col(p) + F.col(s)).cast("decimal(38,0)").alias(p) for p, s in (("p1", "s1"), ("p2", "s2"))])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations to keep, from ``numbered_turns``."""
    at = F.struct("at", "p1", "p2")
    whole = turns.groupBy("conv").agg(F.max(at).alias("last"), F.min("conv_id").alias("conv_id"))
    whole = whole.select("conv", "conv_id", F.col("last.at").alias("at"), F.col("last.p1").alias("p1"), F.col("last.p2").alias("p2"))
    groups = whole.groupBy("at", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "conv")).alias("first"), F.count(F.lit(1)).alias("n_copies"))
    # a prefix that some longer conversation has: any turn that is not the last of its conversation
    ends = whole.select("conv", F.col("at").alias("end"))
    prefixes = turns.select("conv", "at", "p1", "p2").join(ends, "conv").where("at < end").select("at", "p1", "p2").distinct()
    kept = groups.join(prefixes, ["at", "p1", "p2"], "left_anti")
    return kept.select(F.col("first.conv").alias("conv"), (F.col("at") + 1).alias("n_turns"), "n_copies")


def rendered(turns: DataFrame, kept: DataFrame) -> DataFrame:
    line = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(END))
    texts = turns.select("conv", "conv_id", "at", line.alias("line")).join(kept, "conv")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    return texts.groupBy("conv", "n_turns", "n_copies").agg(F.min("conv_id").alias("conv_id"), joined.alias("text")).select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.col("n_copies").cast("long").alias("n_copies"), "text")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, text): one rendered row per maximal conversation."""
    t = materialize(numbered_turns(turns), "numbered-turns")
    return rendered(t, materialize(maximal(t), "maximal"))


SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS i,
                  coalesce('+' || role, '-') || '|' || coalesce('+' || text, '-') AS c,
                  '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' AS l
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, i, md5(string_agg(len(c) || ':' || c, '|') OVER (PARTITION BY conv_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h FROM t),
w AS (SELECT conv_id, max(i) AS n, arg_max(h, i) AS h FROM p GROUP BY conv_id),
g AS (SELECT n, h, min(conv_id) AS conv_id, count(*) AS n_copies FROM w GROUP BY n, h),
x AS (SELECT DISTINCT p.i AS n, p.h FROM p JOIN w USING (conv_id) WHERE p.i < w.n),
k AS (SELECT g.* FROM g ANTI JOIN x USING (n, h))
SELECT k.conv_id, CAST(any_value(n) AS BIGINT) AS n_turns, CAST(any_value(n_copies) AS BIGINT) AS n_copies,
       string_agg(l, chr(10) ORDER BY i) AS text
FROM k JOIN t USING (conv_id) GROUP BY k.conv_id
"""
