"""Operator 11, cross-tokenizer alignment by exact-text deduplication.

Texts are shuffled as they are, and each distinct one is tokenised and aligned once.  Pair counts are weighted by how many
documents hold a text; what a text's links come to is then looked up and joined to the documents by the text's digest.

Pairs that more than one of SHARE link rows are of are fewer than SHARE, so they are looked up from a broadcast table, and
no key of the join of the others holds more than that share.  The same goes for texts of very many documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.llm.common import cut, id_and_text, join_to_rows, remove, settings, shared_folder
from oceanloom.llm.tokens import byte_encoder, byte_tokens, piece_encoder, piece_tokens

#: Pairs with more than this part of all link rows are looked up from a broadcast table.
SHARE = 1 << 16
#: Distinct pairs that a task adds up before it hands them on.
PAIRS_AT_ONCE = 1 << 20
_TEXTS = "key BINARY, n BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, groups_sha256 STRING, a ARRAY<INT>, b ARRAY<INT>, times ARRAY<INT>"
_LOOKED_UP = "key BINARY, n BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, groups_sha256 STRING, best BIGINT, total BIGINT, a ARRAY<INT>, b ARRAY<INT>, times ARRAY<INT>"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Aligner:
    """Ids of both vocabularies and the groups that their common ends cut."""

    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        a, b = byte_tokens(vocabulary), piece_tokens(model)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (a, b))
        self.encode_a, self.encode_b = byte_encoder(vocabulary, ranks, special=False), piece_encoder(model, b)
        # Each id as text with what may follow it: within a side, after A's side, after the group.
        self.written = np.array([f"{k}{end}" for k in range(max(len(a), len(b))) for end in ",|;"], object)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and of B, and for each group the place of its last token in both; None without tokens.

        The byte-level vocabulary holds every byte, so its tokens' bytes are always the text's.
        """
        b = self.encode_b(text) if text else None
        if b is None:
            return None
        a, b = np.array(self.encode_a(" " + text), np.int64), np.array(b, np.int64)
        _, last_a, last_b = np.intersect1d(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]), assume_unique=True, return_indices=True)
        return a, b, last_a, last_b

    def groups_text(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        out = np.empty(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 2
        group_a = np.cumsum(ends_a) - ends_a  # the number of groups before each token
        group_b = (np.cumsum(ends_b) - ends_b) // 2
        before_b = np.concatenate(([0], last_b + 1))  # B tokens before each group
        through_a = last_a + 1  # A tokens up to each group's end
        out[np.arange(len(a)) + before_b[group_a]] = 3 * a + ends_a
        out[np.arange(len(b)) + through_a[group_b]] = 3 * b + ends_b
        return "".join(self.written[out].tolist())[:-1]


def _packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def _lists(values: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, pa.int32()))


def aligned_texts(docs: DataFrame, vocabulary: str, ranks: str, pieces: str) -> DataFrame:
    """One row for each distinct text: its digest, its documents' number, its measures, and its distinct links with how often each stands."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabulary, ranks, pieces)
        for batch in batches:
            sizes, shas, links = [], [], []
            for text in batch.column("text").to_pylist():
                found = aligner(text)
                if found is None:
                    sizes.append((0, 0, 0))
                    shas.append("")
                    links.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    continue
                a, b, last_a, last_b = found
                sizes.append((len(a), len(b), len(last_a)))
                shas.append(hashlib.sha256(aligner.groups_text(*found).encode()).hexdigest())
                links.append(np.unique(_packed(a[last_a], b[last_b]), return_counts=True))
            if not sizes:
                continue
            pairs, lengths = np.concatenate([x[0] for x in links]), [len(x[0]) for x in links]
            numbers = [pa.array([s[k] for s in sizes], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), *numbers, pa.array(shas, pa.string()), _lists(pairs >> 32, lengths), _lists(pairs & 0xFFFFFFFF, lengths), _lists(np.concatenate([x[1] for x in links]), lengths)],
                ["key", "n", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b", "times"],
            )

    texts = id_and_text(docs).where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    return texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "n", "text").mapInArrow(align, _TEXTS)


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sizes(column: pa.ListArray) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def pair_counts(texts: DataFrame) -> DataFrame:
    """``a, b, n, texts, is_best``: each linked pair's count over all documents, the texts that hold it, and whether no other pair of its B id has more."""

    def emit(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
        n, rows = np.zeros(len(pairs), np.int64), np.bincount(at, minlength=len(pairs))
        np.add.at(n, at, np.concatenate(counts))
        return pa.RecordBatch.from_arrays([pa.array(pairs >> 32, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(n), pa.array(rows, pa.int64())], ["a", "b", "n", "texts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            each = np.repeat(batch.column("n").to_numpy(), _sizes(batch.column("a")))
            keys.append(_packed(_flat(batch.column("a")), _flat(batch.column("b"))))
            counts.append(_flat(batch.column("times")) * each)
            held += len(keys[-1])
            if held >= PAIRS_AT_ONCE:
                yield emit(keys, counts)
                keys, counts, held = [], [], 0
        if keys:
            yield emit(keys, counts)

    counted = texts.select("n", "a", "b", "times").mapInArrow(add_up, "a INT, b INT, n BIGINT, texts BIGINT").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    best = counted.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of B's vocabulary at most
    return counted.join(F.broadcast(best), "b").select("a", "b", "n", "texts", (F.col("n") == F.col("most")).alias("is_best"))


def _looked_up(texts: DataFrame, hot: list) -> DataFrame:
    """The texts with what their links among the hot pairs come to; the other links stay as they are."""
    rows = sorted(((r["a"] << 32 | r["b"], r["n"], r["is_best"]) for r in hot))
    keys, counts, best = (np.array([r[k] for r in rows], np.int64) for k in range(3))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, sizes = _packed(_flat(batch.column("a")), _flat(batch.column("b"))), _flat(batch.column("times")), _sizes(batch.column("a"))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums = []
            for values in (best, counts):
                out = np.zeros(len(sizes), np.int64)
                np.add.at(out, owner[known], times[known] * values[at[known]])
                sums.append(pa.array(out))
            rest, left = np.bincount(owner[~known], minlength=len(sizes)), ~known
            same = ["key", "n", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in same), *sums, _lists(pairs[left] >> 32, rest), _lists(pairs[left] & 0xFFFFFFFF, rest), _lists(times[left], rest)], [*same, "best", "total", "a", "b", "times"]
            )

    return texts.mapInArrow(look_up, _LOOKED_UP)


def text_measures(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``key, n`` and the measures of each distinct text."""
    rows = pairs.agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("rows")).first()["rows"]
    is_hot = F.col("texts") * SHARE > rows
    hot = pairs.where(is_hot).select("a", "b", "n", "is_best").collect()  # fewer than SHARE
    each = _looked_up(texts, hot).select("key", "n", "n_a", "n_b", "n_groups", "groups_sha256", "best", "total", F.posexplode_outer(F.arrays_zip("a", "b", "times")).alias("at", "link"))
    none = F.col("link").isNull()  # texts without a link left meet nothing, each at a place of its own
    links = each.select(
        "key", "n", "n_a", "n_b", "n_groups", "groups_sha256", F.when(none | (F.col("at") == 0), F.col("best")).otherwise(0).alias("best"), F.when(none | (F.col("at") == 0), F.col("total")).otherwise(0).alias("total"),
        F.coalesce(F.col("link.a"), -1 - F.pmod(F.hash("key"), F.lit(SHARE))).alias("a"), F.coalesce(F.col("link.b"), F.lit(-1)).alias("b"), F.col("link.times").alias("times"),
    )
    cold = pairs.where(~is_hot).select("a", "b", F.col("n").alias("count"), "is_best")
    joined = links.join(cold, ["a", "b"], "left")
    found = lambda c: F.coalesce(F.col("times") * c, F.lit(0))
    return joined.groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("n", "n_a", "n_b", "n_groups", "groups_sha256")), F.sum(F.col("best") + found(F.col("is_best").cast("bigint"))).alias("n_best"), F.sum(F.col("total") + found(F.col("count"))).alias("count_sum"),
    ).withColumn("n_links", F.col("n_groups"))  # two tokens end together exactly at a group's end


def align(docs: DataFrame, vocabulary: str, ranks: str, pieces: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    Null and empty texts, and texts whose pieces don't give the text back, have no tokens: zeros and an empty digest column.
    Repeated rows each have their result, and each counts; rows without an id have a result without one.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    try:
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}):
            aligned_texts(docs, vocabulary, ranks, pieces).write.option("compression", "zstd").parquet(f"{folder}/texts")
            texts = spark.read.parquet(f"{folder}/texts")
            pair_counts(texts).write.parquet(f"{folder}/pairs")
            measured = text_measures(texts, spark.read.parquet(f"{folder}/pairs"))
            keyed = id_and_text(docs).select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key"))
            zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in MEASURES}
            joined = join_to_rows(keyed, cut(measured), "key", "n", [*MEASURES, "groups_sha256"])
            return cut(joined.select("doc_id", *zero.values(), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
    finally:
        remove(spark, folder)
