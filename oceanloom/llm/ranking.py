"""Operator 12, ranked lexical search: dense float64 products of item vocabulary tiles and document impact tiles.

Items are taken in blocks, each with a compact vocabulary of its own terms.  A pass over the documents keeps, for a block,
how often each document has its terms; a second pass multiplies tiles of at most TILE_TERMS weights by impacts.  Weights
and impacts are whole numbers, and a tile is only as wide as keeps every sum below 2**53, so its products are exact in any
order of addition; tiles are then added up as 64-bit integers.  Each task keeps every item's best documents, ties by id,
and these are merged in two steps.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oceanloom.llm.common import cut, remove, settings, shared_folder

TOP = 10
#: Documents and terms of a tile, and items of a block; an item that alone has more terms than a block may hold is a block.
TILE_DOCS, TILE_TERMS, BLOCK_ITEMS, BLOCK_TERMS = 512, 4096, 1024, 1 << 18
EXACT = 1 << 53
#: Parts that an item's candidates are merged in before they meet.
MERGE_PARTS = 64

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_COUNTS = "doc_id BIGINT, n BIGINT, term ARRAY<INT>, tf ARRAY<INT>"
_BEST = "item INT, doc_id BIGINT, score BIGINT, part INT"


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(total: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, in blocks of bounded size; rows of one id are one item."""
    block, held, last, own = [], 0, ..., set()

    def ready(item, own):
        return (item, sorted(own))

    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).orderBy("item_id").toLocalIterator():
        if last is not ... and r["item_id"] != last:
            if block and (len(block) >= BLOCK_ITEMS or held + len(own) > BLOCK_TERMS):
                yield block
                block, held = [], 0
            block.append(ready(last, own))
            held, own = held + len(own), set()
        last = r["item_id"]
        own.update(terms(r["text"]))
    if last is not ...:
        if block and (len(block) >= BLOCK_ITEMS or held + len(own) > BLOCK_TERMS):
            yield block
            block = []
        block.append(ready(last, own))
    if block:
        yield block


def block_counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, term, tf`` of each document with terms: how many it has, and its counts of the vocabulary's."""
    number = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})  # at most BLOCK_TERMS, or one item's

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = number.value.get
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = terms(text)
                if found:
                    tf = Counter(map(find, found))
                    tf.pop(None, None)
                    out.append((doc, len(found), list(tf.keys()), list(tf.values())))
            if out:
                types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, _COUNTS)


def holding_counts(counts: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the vocabulary's terms: each task adds up its own, one row a term."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("term").flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], ["term", "df"])

    df = np.zeros(size, np.int64)
    for r in counts.select("term").mapInArrow(add_up, "term INT, df BIGINT").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    return df


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def tile_width(heaviest: int) -> int:
    """Terms of a tile: a sum of so many products of the largest weight and impact stays below 2**53."""
    return max(1, min(TILE_TERMS, (EXACT - 1) // max(1, heaviest * 1_000_000)))  # an impact is below 10**6


class Scorer:
    """Exact scores of all items of a block for a tile of documents."""

    def __init__(self, weights: np.ndarray, items: np.ndarray, item_terms: np.ndarray, n_items: int):
        """``items`` and ``item_terms`` say which item holds which term; ``weights`` is each term's."""
        order = np.argsort(item_terms, kind="stable")
        self.items, self.terms, self.weights, self.n_items = items[order], item_terms[order], weights, n_items
        self.width = tile_width(int(weights.max(initial=0)))

    def __call__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Items by documents; the three arrays give each document's terms and impacts."""
        scores = np.zeros((self.n_items, n_docs), np.int64)
        there = np.unique(term)
        for k in range(0, len(there), self.width):
            tile = there[k : k + self.width]
            a, b = np.searchsorted(self.terms, tile[0]), np.searchsorted(self.terms, tile[-1], "right")
            at = np.searchsorted(tile, self.terms[a:b])
            own = tile[at] == self.terms[a:b]
            left = np.zeros((self.n_items, len(tile)))
            left[self.items[a:b][own], at[own]] = self.weights[self.terms[a:b][own]]
            here = (term >= tile[0]) & (term <= tile[-1])
            right = np.zeros((len(tile), n_docs))
            right[np.searchsorted(tile, term[here]), owner[here]] = impact[here]
            scores += (left @ right).astype(np.int64)
        return scores


def best_of(scores: np.ndarray, ids: np.ndarray, has_id: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row of scores above 0 the best by score, then id, those without an id last; ties at the edge are settled by id, not by place."""
    out = []
    k = scores.shape[1] - top
    edges = np.partition(scores, k, axis=1)[:, k] if k > 0 else np.zeros(len(scores), np.int64)
    for row, edge in zip(scores, edges, strict=True):
        at = np.flatnonzero((row >= edge) & (row > 0))
        at = at[np.lexsort((ids[at], ~has_id[at], -row[at]))[:top]]
        out.append((row[at], ids[at], has_id[at]))
    return out


def block_best(counts: DataFrame, block: list[tuple[int | None, list[bytes]]], vocabulary: list[bytes], df: np.ndarray, total: int, length: int, top: int) -> DataFrame:
    """``item, doc_id, score, part``: each task's best documents of each of the block's items, by the item's place in the block."""
    number = {t: k for k, t in enumerate(vocabulary)}
    items = np.concatenate([np.full(len(own), k, np.int64) for k, (_, own) in enumerate(block)])
    held = np.array([number[t] for _, own in block for t in own], np.int64)
    weights = np.array([weight(total, int(n)) for n in df], np.int64)
    shared = counts.sparkSession.sparkContext.broadcast((weights, items, held))
    n_items = len(block)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value, n_items)
        empty = np.zeros(0, np.int64)
        kept, part = [(empty, empty, np.zeros(0, bool))] * n_items, 0
        for batch in batches:
            for first in range(0, batch.num_rows, TILE_DOCS):
                b = batch.slice(first, TILE_DOCS)
                ids = b.column("doc_id")
                has_id, ids = np.array(ids.is_valid()), ids.fill_null(0).to_numpy()
                m = np.array([100 - 90 + (90 * n * total) // length for n in b.column("n").to_pylist()], np.int64)
                sizes = np.diff(b.column("term").offsets.to_numpy())
                owner = np.repeat(np.arange(b.num_rows), sizes)
                term, tf = (b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("term", "tf"))
                if not len(term):
                    continue
                part = int(ids[0]) % MERGE_PARTS
                found = best_of(scorer(owner, term, impacts(tf, m[owner]), b.num_rows), ids, has_id, top)
                for k, (new, old) in enumerate(zip(found, kept, strict=True)):
                    if len(new[0]):
                        s, d, h = (np.concatenate(x) for x in zip(new, old, strict=True))
                        at = np.lexsort((d, ~h, -s))[:top]
                        kept[k] = s[at], d[at], h[at]
        sizes = [len(x[0]) for x in kept]
        s, d, h = (np.concatenate([x[k] for x in kept]) for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(n_items), sizes), pa.int32()), pa.array(d, pa.int64(), mask=~h), pa.array(s), pa.array(np.full(len(s), part), pa.int32())], ["item", "doc_id", "score", "part"]
        )

    return counts.mapInArrow(score, _BEST)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best documents with a score above 0, equal scores by id.

    Null and empty texts have no terms, and count for nothing.  Item rows of one id are one item; an item without terms has no
    rows.  Repeated documents each have a place; those without an id come last among equal scores.  Empty tables give no rows.
    """
    spark, out = docs.sparkSession, _nothing(docs.sparkSession)
    folder = f"{shared_folder(spark)}/ranking-{uuid.uuid4().hex}"
    try:
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
            for k, block in enumerate(item_blocks(items)):
                vocabulary = sorted({t for _, own in block for t in own})
                if not vocabulary:
                    continue
                block_counts(docs, vocabulary).write.option("compression", "zstd").parquet(f"{folder}/{k}")
                counts = spark.read.parquet(f"{folder}/{k}")
                total, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
                if not total:
                    break
                found = block_best(counts, block, vocabulary, holding_counts(counts, len(vocabulary)), total, length, top)
                for by in (["item", "part"], ["item"]):
                    found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= top)
                ids = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(block)], "item INT, item_id BIGINT")
                out = out.unionByName(cut(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")))  # at most `top` rows an item
                remove(spark, f"{folder}/{k}")
        return out
    finally:
        remove(spark, folder)
