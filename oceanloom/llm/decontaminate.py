"""Operator 5, benchmark decontamination: size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity, so sets of
such different sizes are searched by containment: each item's MinHash sketch is
its least shingle hashes, more of them for larger size classes, and the share of
an item's sketch that a document holds estimates the share of the item's
shingles that it holds.  Candidates are verified by exact shingle containment.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oceanloom.llm.common import cut

SHINGLE = 5
CONTAINMENT = 0.8
#: Sketch size of the smallest size class, and how many hashes each doubling adds; the share of a sketch that makes a candidate.
SKETCH, SKETCH_STEP, CANDIDATE_SHARE = 16, 4, 0.3
#: Rows that may be broadcast: a few tens of megabytes.  Larger sides are shuffled.
BROADCAST_ROWS = 500_000
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_A_WORD), "")


def shingles(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``keys, h``: the hash of each run of n words of ``text``, as often as it stands there."""
    split = rows.select(*keys, words(F.col("text")).alias("_w")).where(F.size("_w") >= n)
    at = split.select(*keys, "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - n)).alias("_i"))
    return at.select(*keys, F.xxhash64(F.lit(n), *[F.get("_w", F.col("_i") + k) for k in range(n)]).alias("h"))


def _if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, marked for broadcast if it was counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def leaks(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shingles, n_found, containment`` of each document and item it holds to that share.

    An item shorter than five words is one shingle of all its words; an item without words is found nowhere.  Rows of one
    ``doc_id`` are told apart by their texts; repeated rows give one result.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    asked = asked.withColumn("item_hash", F.xxhash64("item_id", "text")).withColumn("n", F.least(F.lit(SHINGLE), F.size(words(F.col("text")))))
    lengths = [r["n"] for r in asked.where("n > 0").select("n").distinct().collect()]  # at most five numbers
    if not lengths:
        asked, lengths = asked.where("false"), [SHINGLE]
    sets = None
    for n in sorted(lengths):
        some = shingles(asked.where(F.col("n") == n), ["item_id", "item_hash"], n).distinct()
        sets = some if sets is None else sets.unionByName(some)
    item = Window.partitionBy("item_hash")
    sized = sets.withColumn("n_shingles", F.count("*").over(item)).withColumn("rank", F.row_number().over(item.orderBy("h")))
    sketch_size = F.lit(SKETCH) + F.lit(SKETCH_STEP) * F.floor(F.log2(F.greatest(F.col("n_shingles") / SKETCH, F.lit(1.0)))).cast("int")
    sized = cut(sized.withColumn("sketch", F.least(sketch_size, F.col("n_shingles").cast("int"))))

    def found(probe: DataFrame, rows: DataFrame) -> DataFrame:
        """Distinct shingles of ``probe`` in each row, counted by row and item."""
        hits = None
        for n in sorted(lengths):
            some = shingles(rows, ["doc_id", "text_hash"], n).join(_if_small(probe), "h")
            hits = some if hits is None else hits.unionByName(some)
        return hits.distinct().groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.count("*").alias("n_found"), F.first("need").alias("need"), F.first("n_shingles").alias("n_shingles"))

    sketches = sized.where("rank <= sketch").select("h", "item_id", "item_hash", "n_shingles", F.greatest(F.lit(1), F.floor(F.col("sketch") * CANDIDATE_SHARE)).cast("bigint").alias("need"))
    candidates = cut(found(sketches, own).where("n_found >= need").select("doc_id", "text_hash", "item_hash"))
    wanted_docs = candidates.select("doc_id", "text_hash").distinct()
    wanted_items = candidates.select("item_hash").distinct()
    near = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t"))
    rows = own.join(_if_small(wanted_docs.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"))), near, "left_semi")
    full = sized.join(wanted_items, "item_hash", "left_semi").select("h", "item_id", "item_hash", "n_shingles", F.lit(1).cast("bigint").alias("need"))
    exact = found(full, rows).withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= containment)
    return exact.select("doc_id", "text_hash", "item_id", "n_shingles", "n_found", "containment")


def drop_leaking(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The rows that hold no item, all columns as they were."""
    bad = cut(leaks(docs, items, containment).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct())
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("bigint").alias("_i"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"))
    clean = row.join(_if_small(bad), F.col("_i").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left_anti")
    return clean.select("_row.*")
