"""Operator 1, document fingerprints: content-defined chunking with a normalised gear hash.

A gear hash over the last 16 code points marks cut points, harder to meet before
the target size than after it, so chunk sizes gather around the target.  A
fingerprint is the set of a text's chunk digests with their lengths; likeness is
the length-weighted containment of the smaller set in the larger.  Inserting or
removing text moves the chunks beside it only.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.llm import textnum
from oceanloom.llm.common import id_and_text, small_batches

#: Chunk lengths in code points.  The strict test passes one position in 128, the loose one in 8.
SMALLEST, TARGET, LARGEST = 8, 32, 128
STRICT_BITS, LOOSE_BITS = 7, 3
#: Code points of the gear hash.
WINDOW = 16


def gear(cp: np.ndarray) -> np.ndarray:
    """Rolling hash: the sum of g(c) << age over the last 16 code points, by doubling the window four times."""
    h = (textnum.mix(cp.astype(np.uint64) + np.uint64(7)) >> np.uint64(32)).astype(np.uint32)
    for width in (1, 2, 4, 8):
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h = more
    return h


def _ends(cp: np.ndarray, first: int, last: bool) -> np.ndarray:
    """Ends of the chunks from ``first`` on; where more code points follow, only those that they can't change."""
    n, h = len(cp), gear(cp)
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = (loose[h[loose] >> np.uint32(32 - STRICT_BITS) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    out, at, s, k = [], first, 0, 0
    while n - at > SMALLEST if last else n - at >= LARGEST:
        s = bisect_left(strict, at + SMALLEST, s)
        if s < len(strict) and strict[s] < at + TARGET:
            end = strict[s]
        else:
            k = bisect_left(loose, at + TARGET, k)
            end = loose[k] if k < len(loose) else n
            end = min(end, at + LARGEST)
        at = min(end, n)
        out.append(at)
    if last and at < n:
        out.append(n)
    return np.array(out, np.int64)


def blocks(cp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place, code points and chunk limits (the first start, then the ends) of blocks of a text.

    A block begins where the last whole chunk of the one before ended, and reads the hash's window before that, so the chunks
    are those of the text in one piece.
    """
    at, n = 0, len(cp)
    while at < n:
        lo, hi = max(at - WINDOW + 1, 0), min(at + textnum.BLOCK, n)
        ends = _ends(cp[lo:hi], at - lo, hi == n)
        yield lo, cp[lo:hi], np.concatenate(([at - lo], ends))
        at = lo + int(ends[-1])


def cut_points(cp: np.ndarray) -> np.ndarray:
    """Ends of the chunks, ascending; the last is the text's length."""
    return np.concatenate([np.zeros(0, np.int64), *(lo + limits[1:] for lo, _, limits in blocks(cp))])


def chunks(text: str) -> list[str]:
    """The text in its chunks; joined they are the text."""
    ends = cut_points(textnum.codepoints(text)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def fingerprint(text: str) -> np.ndarray:
    """Ascending distinct values ``digest << 8 | length``: 32 bits of digest, 8 of length."""
    found = []
    for _, piece, limits in blocks(textnum.codepoints(text)):
        starts, ends = limits[:-1], limits[1:]
        digests = textnum.segment_hashes(textnum.prefix_sums(piece), starts, ends)
        found.append((digests >> np.uint64(32) << np.uint64(8)) | (ends - starts).astype(np.uint64))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def as_text(fp: np.ndarray) -> str:
    """Ten hexadecimal digits for each chunk."""
    return fp.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 3:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Length-weighted containment of the smaller in the larger; 1 for two empty texts, 0 for one."""
    size = [int((x & np.uint64(255)).sum()) for x in (a, b)]
    if min(size) == 0:
        return float(max(size) == 0)
    return float((np.intersect1d(a, b, assume_unique=True) & np.uint64(255)).sum()) / min(size)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every text; an empty text has the empty fingerprint."""
    small_batches(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "fingerprint": [as_text(fingerprint(t)) for t in texts]})

    return id_and_text(docs).mapInArrow(each, "doc_id BIGINT, n_chars BIGINT, fingerprint STRING")


def _with_successors(docs: DataFrame, ranges: int) -> DataFrame:
    """``doc_id, text, _range, _guest`` sorted so that each row's successor (descending id; after the last the first) follows it.

    Rows are dealt by ranges of ids; rows without an id, which come last, by ranges of a hash of their texts.  The first row of
    each range also goes, as a guest, to the end of the range before it, so no task needs another task's rows.  Only range limits
    are collected: one number for each range.
    """
    rows = id_and_text(docs)
    splits = sorted(set(rows.stat.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges)))) if ranges > 1 else []
    limits = F.array(*[F.lit(int(s)) for s in splits]).cast("array<bigint>")
    key = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    of_id = F.size(F.filter(limits, lambda s: s <= F.col("doc_id"))) if splits else F.lit(0)
    of_hash = F.least(F.floor((F.col("_key") / 2.0**64 + 0.5) * ranges), F.lit(ranges - 1))
    dealt = rows.withColumn("_key", key).withColumn("_range", F.when(F.col("doc_id").isNull(), of_hash).otherwise(ranges + of_id).cast("int"))
    heads = {r["_range"]: r["top"] for r in dealt.groupBy("_range").agg(F.max("_key").alias("top")).collect()}
    if not heads:
        return dealt.drop("_key").withColumn("_guest", F.lit(False))
    order = sorted(heads, reverse=True)
    host = {r: order[k - 1] for k, r in enumerate(order)}  # the range before; that of the first is the last
    top = F.element_at(F.array(*[F.lit(heads.get(r)).cast("bigint") for r in range(max(order) + 1)]), F.col("_range") + 1)
    hosts = F.element_at(F.array(*[F.lit(host.get(r)).cast("int") for r in range(max(order) + 1)]), F.col("_range") + 1)
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    places = F.when(F.col("_key") == top, F.array(own, F.struct(hosts.alias("r"), F.lit(True).alias("g")))).otherwise(F.array(own))
    placed = dealt.select("doc_id", "text", "_key", F.explode(places).alias("p")).select("doc_id", "text", "_key", F.col("p.r").alias("_range"), F.col("p.g").alias("_guest"))
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return placed.repartition(partitions, "_range").sortWithinPartitions("_range", "_guest", F.desc("_key"), "text").drop("_key")


def compare_edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each text beside its edited text and beside the next document.

    The edited text is the text with its last ``n_chars // 3`` code points replaced by the first as many (or all) of the next
    document, in descending ``doc_id``; the first follows the last.  Rows of one id stand in the order of their texts; null ids
    come last, in the order of a hash of their texts.  A lone document is its own successor.  A null text counts as empty: no chunks,
    and the empty fingerprint.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranges = ranges or 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        before = None
        for b in batches:
            out: list[tuple] = []
            for doc, text, place, guest in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_guest")), strict=True):
                if guest and (before is None or before[3] != place):
                    continue  # a second guest of the same range
                fp = fingerprint(text)
                if before is not None and before[3] == place:
                    of, old, old_fp, _ = before
                    k = len(old) // 3
                    edited = old[: len(old) - k] + text[:k]
                    edited_fp = fingerprint(edited) if k else old_fp
                    out.append((of, len(old), hashlib.sha256(edited.encode()).hexdigest(), as_text(old_fp), as_text(edited_fp), likeness(old_fp, edited_fp), likeness(old_fp, fp)))
                before = None if guest else (doc, text, fp, place)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    schema = "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"
    return _with_successors(docs, ranges).mapInArrow(each, schema)
