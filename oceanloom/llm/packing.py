"""Operator 7, packing: first-fit decreasing with a tournament tree of bin capacities, in randomised groups of documents.

Whole multiples of the sequence length leave a document as full sequences.  The
remainders of a group are placed first-fit decreasing; a tree of the largest
room below each node finds the leftmost bin with room in logarithmic time.  Bins
that stay open are then closed by cutting the emptiest ones into the gaps of the
fullest, and the one bin left over is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from oceanloom.llm.common import id_and_text, small_batches
from oceanloom.llm.tokens import byte_encoder

LENGTH = 1024
DOCS_PER_GROUP = 4096
#: Full sequences that are handed on together.
FULL_PER_LOT = 1024
END_OF_TEXT = 0
_PIECES = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT"


class TournamentTree:
    """Room in each bin, with the largest room below each inner node."""

    def __init__(self, bins: int):
        self.leaves = 1 << max(bins - 1, 1).bit_length()
        self.room = [0] * (2 * self.leaves)
        self.opened = 0

    def set(self, k: int, room: int) -> None:
        t, at = self.room, self.leaves + k
        t[at] = room
        at >>= 1
        while at:
            best = max(t[2 * at], t[2 * at + 1])
            if t[at] == best:
                break
            t[at] = best
            at >>= 1

    def first_fit(self, size: int) -> int:
        """The leftmost bin with that much room, or -1."""
        t = self.room
        if t[1] < size:
            return -1
        at = 1
        while at < self.leaves:
            at *= 2
            if t[at] < size:
                at += 1
        return at - self.leaves


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of item numbers; equal sizes keep their order."""
    tree, bins = TournamentTree(max(len(sizes), 1)), []
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        k = tree.first_fit(sizes[item])
        if k < 0:
            k = len(bins)
            bins.append([])
            tree.set(k, length)
        bins[k].append(item)
        tree.set(k, tree.room[tree.leaves + k] - sizes[item])
    return bins


def close_bins(bins: list[list[int]], sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length): open bins filled by cutting the emptiest, the last one cut into powers of two."""
    full = [[(i, 0, sizes[i]) for i in b] for b in bins if sum(sizes[i] for i in b) == length]
    rest = sorted(([(i, 0, sizes[i]) for i in b] for b in bins if sum(sizes[i] for i in b) < length), key=lambda b: -sum(p[2] for p in b))
    lo, hi = 0, len(rest) - 1
    while lo < hi:
        gap = length - sum(p[2] for p in rest[lo])
        if not gap:
            lo += 1
        elif not rest[hi]:
            hi -= 1
        else:
            item, start, n = rest[hi].pop()
            take = min(gap, n)
            rest[lo].append((item, start, take))
            if n > take:
                rest[hi].append((item, start + take, n - take))
    out = full
    for k, pieces in enumerate(rest):
        if k != lo or sum(p[2] for p in pieces) in (0, length):
            out += [pieces] if pieces else []
            continue
        left, todo = sum(p[2] for p in pieces), pieces[::-1]
        for bit in reversed(range(left.bit_length())):
            if not left & (1 << bit):
                continue
            room, sequence = 1 << bit, []
            while room:
                item, start, n = todo.pop()
                take = min(room, n)
                sequence.append((item, start, take))
                room -= take
                if n > take:
                    todo.append((item, start + take, n - take))
            out.append(sequence)
    return out


def pack(docs: DataFrame, vocabulary: str, ranks: str, length: int = LENGTH, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each document is its ids and then id 0, so an empty or null text is one id.  Long documents are cut where they are read, and
    full sequences get their numbers there; they meet in small lots of their own.  Groups of the rest are dealt by a hash of the
    id, the text and which repetition of these in its task a row is, so repeated rows spread and no group depends on the order
    of rows; a group has about ``docs_per_group`` documents, each with less than one sequence of ids, which bounds a task's memory.
    """
    spark = docs.sparkSession
    small_batches(spark)
    groups = max(1, docs.count() // docs_per_group)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, times = byte_encoder(vocabulary, ranks, special=True), Counter()  # of each row's hash, how often this task has had it
        task, full = TaskContext.get().partitionId(), 0  # numbers of full sequences lie beyond those of all groups
        for b in batches:
            out = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text), END_OF_TEXT], np.uint32).astype("<u4")
                n, whole = len(ids), len(ids) // length * length
                name = f"{doc}:{n}:{zlib.crc32(ids.tobytes())}"
                row = times[key := hash(name)]
                times[key] += 1
                group = zlib.crc32(f"{name}:{row}".encode()) % groups
                for k in range(0, whole, length):
                    lot = -1 - zlib.crc32(f"{task}:{full // FULL_PER_LOT}".encode())
                    out.append((lot, (groups + task) << 40 | full, doc, k, length, zlib.crc32(ids[k : k + length].tobytes()), n, None))
                    full += 1
                if n > whole:
                    out.append((group, row, doc, whole, n - whole, None, n, ids[whole:].astype("<u2").tobytes() if ids.max() < 65536 else b"\0" + ids[whole:].tobytes()))
            if out:
                columns = ["g", "row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], columns)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def ids_of(raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, "<u2").astype("<u4") if len(raw) % 2 == 0 else np.frombuffer(raw[1:], "<u4")

    def place(group: pa.Table) -> pa.Table:
        if group.column("g")[0].as_py() < 0:
            return pa.table([*(group.column(c) for c in names[:5]), group.column("row"), pa.array(np.zeros(len(group), np.int64))], names=names)
        tails = sorted(group.to_pylist(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["row"]))
        first_id, out = tails[0]["g"] << 40, []
        sizes = [r["length"] for r in tails]
        for pieces in close_bins(first_fit_decreasing(sizes, length), sizes, length):
            at = 0
            for item, first, n in pieces:
                r = tails[item]
                out.append((r["doc_id"], r["start"] + first, n, zlib.crc32(ids_of(r["ids"])[first : first + n].tobytes()), r["doc_tokens"], first_id, at))
                at += n
            first_id += 1
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(names, zip(*out, strict=True), strict=True)})

    pieces = id_and_text(docs).mapInArrow(cut, "g BIGINT, row BIGINT, doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, ids BINARY")
    return pieces.groupBy("g").applyInArrow(place, _PIECES)
