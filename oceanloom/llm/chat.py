"""Operator 6, chat formatting: cumulative-snapshot collapse, then rendering.

Loggers often store a conversation after every turn.  Each turn gets the rolling
hash of all turns up to it; a conversation whose last hash is an inner hash of
another is a prefix of it and drops by an anti-join.  What stays is rendered.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, alone, pos, role, text, h1, h2, is_last``: turns numbered from 1, with 128 bits of hash over all turns so far.

    The hash is the running exclusive-or of hashes of (position, role, text), so it needs no state but the sum.  Turns stand in the
    order of turn, role, text; a repeated row counts once; null roles and texts are empty; null turns come first.  Rows without
    a ``conv_id`` belong to no other row: each is a conversation of one turn, told apart by ``alone``, a hash of the row that is 0 elsewhere.
    """
    own = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = own.withColumn("alone", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.lit(0)))
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "text")
    same = F.lag("turn").over(order).eqNullSafe(F.col("turn")) & (F.lag("role").over(order) == F.col("role")) & (F.lag("text").over(order) == F.col("text"))
    kept = own.withColumn("_again", F.coalesce(same, F.lit(False)) & (F.row_number().over(order) > 1)).where("NOT _again")
    numbered = kept.withColumn("pos", F.row_number().over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        "conv_id", "alone", "pos", "role", "text",
        F.expr("bit_xor(xxhash64(pos, role, text))").over(upto).alias("h1"),
        F.expr("bit_xor(xxhash64('second', text, pos, role))").over(upto).alias("h2"),
        F.lead("pos").over(order).isNull().alias("is_last"),
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """``conv_id, alone, n_turns, n_copies`` of conversations that no longer one starts with; of equal ones the least id stays."""
    key = ["pos", "h1", "h2"]
    inner = hashed.where("NOT is_last").select(*key).distinct()
    ends = hashed.where("is_last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.min("alone").alias("alone"), F.count("*").alias("n_copies"))
    alone = F.when(F.col("conv_id").isNull(), F.col("alone")).otherwise(F.lit(0)).alias("alone")
    return ends.join(inner, key, "left_anti").select("conv_id", alone, F.col("pos").cast("bigint").alias("n_turns"), "n_copies")


def render(turns: DataFrame, opening: str = "<|", closing: str = "|>") -> DataFrame:
    """``conv_id, n_turns, n_copies, text``: each maximal conversation, a header line and the text for every turn.

    Null roles and texts are rendered as empty.
    """
    hashed = prefix_hashes(turns)
    kept = maximal(hashed).withColumnsRenamed({"conv_id": "_id", "alone": "_alone"})
    line = F.concat(F.lit(opening), "role", F.lit(closing + "\n"), "text", F.lit("\n"))
    same = F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("alone") == F.col("_alone"))
    rows = hashed.select("conv_id", "alone", "pos", line.alias("line")).join(kept, same)
    whole = rows.groupBy("conv_id", "alone", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("t"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("t", lambda x: x["line"]), "").alias("text"))
