"""Distance from the masked cells of a face, on blocks that exchange their borders.

The distance solves ``|grad d| = 1`` by the first-order upwind scheme, with half a cell between a masked cell and its
neighbour.  Its solution is the only one, so blocks that relax on their own and hand on the borders that have changed
come to what one array for the whole face would: values only fall, and a round without a changed border is the end.  Only
distances below a limit are solved for, so a front enters few blocks, and rounds are about the limit by a block's width.

A task holds one block.  Blocks of a large grid are larger than asked for, up to ``BLOCK``, since each block is a call to Python in each round.  Rounds are written to the shared folder, so each starts from files.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.sources.blocks import side_for
from oceanloom.sources.scratch import remove, shared_folder

BLOCK = 720
#: From each side of a block, the block it leads to and the side it arrives at.
_SIDES = {"n": (-1, 0, "s"), "s": (1, 0, "n"), "w": (0, -1, "e"), "e": (0, 1, "w")}
_KEY = "face INT, jb INT, ib INT, h INT, w INT, dy DOUBLE, dx DOUBLE, held BINARY, masked BINARY"
_BLOCKS = _KEY + "".join(f", out_{s} BINARY" for s in _SIDES)
_STATE = _KEY + ", fixed BINARY, dist BINARY" + "".join(f", in_{s} BINARY, out_{s} BINARY" for s in _SIDES)


def _bits(raw: bytes, shape: tuple[int, int]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=shape[0] * shape[1]).reshape(shape).astype(bool)


def _edge(cells: np.ndarray, side: str) -> np.ndarray:
    return {"n": cells[0], "s": cells[-1], "w": cells[:, 0], "e": cells[:, -1]}[side]


def _padded(cells: np.ndarray, borders: dict[str, np.ndarray | None], empty) -> np.ndarray:
    """The cells within a frame of the neighbours' borders."""
    out = np.full((cells.shape[0] + 2, cells.shape[1] + 2), empty, cells.dtype)
    out[1:-1, 1:-1] = cells
    for side, at in (("n", (0, slice(1, -1))), ("s", (-1, slice(1, -1))), ("w", (slice(1, -1), 0)), ("e", (slice(1, -1), -1))):
        if borders.get(side) is not None:
            out[at] = borders[side]
    return out


def start_distances(masked: np.ndarray, borders: dict[str, np.ndarray | None], dy: float, dx: float) -> np.ndarray:
    """Of open cells beside a masked one the distance to the line between them; infinite elsewhere."""
    p = _padded(masked, borders, False)
    by_j, by_i = p[:-2, 1:-1] | p[2:, 1:-1], p[1:-1, :-2] | p[1:-1, 2:]
    inverse = by_j / (0.5 * dy) ** 2 + by_i / (0.5 * dx) ** 2
    with np.errstate(divide="ignore"):
        return np.where(masked | (inverse == 0), np.inf, inverse**-0.5)


def relax(dist: np.ndarray, borders: dict[str, np.ndarray | None], free: np.ndarray, dy: float, dx: float, limit: float) -> np.ndarray:
    """The least distances below the limit that the scheme allows the free cells, given all others and the borders."""
    p = _padded(dist, borders, np.inf)
    inner, wy, wx = p[1:-1, 1:-1], 1.0 / (dy * dy), 1.0 / (dx * dx)
    while True:
        a, b = np.minimum(p[:-2, 1:-1], p[2:, 1:-1]), np.minimum(p[1:-1, :-2], p[1:-1, 2:])
        at = np.flatnonzero(free & (np.minimum(a, b) < limit))
        if not len(at):
            return inner.copy()
        a, b, old = a.flat[at], b.flat[at], inner[np.unravel_index(at, inner.shape)]
        one = np.minimum(a + dy, b + dx)
        both = np.isfinite(a) & np.isfinite(b)
        fa, fb = np.where(both, a, 0.0), np.where(both, b, 0.0)
        root = (wy * fa + wx * fb) ** 2 - (wy + wx) * (wy * fa * fa + wx * fb * fb - 1.0)
        two = (wy * fa + wx * fb + np.sqrt(np.maximum(root, 0.0))) / (wy + wx)
        new = np.where(both & (root >= 0) & (two >= np.maximum(fa, fb)), two, one)
        better = (new < old) & (new < limit)
        if not better.any():
            return inner.copy()
        inner[np.unravel_index(at[better], inner.shape)] = new[better]


def _packed(mask: DataFrame, spacing: DataFrame, block: int) -> DataFrame:
    """One row for each block; cells that are missing within a face are masked."""
    size = mask.groupBy("face").agg((F.max("j") + 1).alias("nj"), (F.max("i") + 1).alias("ni"))
    faces = F.broadcast(size.join(spacing, "face", "left"))  # a row for each face
    placed = mask.select("face", "j", "i", F.coalesce("masked", F.lit(True)).alias("masked"), F.floor(F.col("j") / block).cast("int").alias("jb"), F.floor(F.col("i") / block).cast("int").alias("ib")).join(faces, "face")

    def pack(group: pa.Table) -> pa.Table:
        face, jb, ib, nj, ni, dy, dx = (group.column(c)[0].as_py() for c in ("face", "jb", "ib", "nj", "ni", "dy_km", "dx_km"))
        h, w = min(block, nj - jb * block), min(block, ni - ib * block)
        masked, held, at = np.ones((h, w), bool), np.zeros((h, w), bool), (group.column("j").to_numpy() - jb * block, group.column("i").to_numpy() - ib * block)
        held[at], masked[at] = True, group.column("masked").to_numpy(zero_copy_only=False).astype(bool)
        row = [face, jb, ib, h, w, dy, dx, np.packbits(held).tobytes(), np.packbits(masked).tobytes(), *(np.packbits(_edge(masked, s)).tobytes() for s in _SIDES)]
        return pa.Table.from_pylist([dict(zip(_names(_BLOCKS), row, strict=True))], _schema(_BLOCKS))

    return placed.groupBy("face", "jb", "ib").applyInArrow(pack, _BLOCKS)


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _schema(ddl: str) -> pa.Schema:
    types = {"INT": pa.int32(), "DOUBLE": pa.float64(), "BINARY": pa.binary()}
    return pa.schema([(n, types[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _sent(blocks: DataFrame) -> DataFrame:
    """``face, jb, ib, side, border``: the borders that blocks hand on, by the block that they go to."""
    each = [F.struct((F.col("jb") + dj).alias("jb"), (F.col("ib") + di).alias("ib"), F.lit(to).alias("side"), F.col(f"out_{s}").alias("border")) for s, (dj, di, to) in _SIDES.items()]
    return blocks.select("face", F.explode(F.array(*each)).alias("b")).select("face", "b.*").where("border IS NOT NULL")


def distances(mask: DataFrame, spacing: DataFrame, limit: float, block: int = BLOCK) -> DataFrame:
    """``face, j, i, masked, km`` of the mask's cells; ``km`` is NULL on masked cells and from the limit on.

    ``spacing`` has ``face, dx_km, dy_km``.  A face without masked cells has no distances, nor has a wholly masked one.
    """
    spark = mask.sparkSession
    block = side_for(mask, block)
    folder = f"{shared_folder(spark)}/distance-{uuid.uuid4().hex}"

    def solve(own: pa.Table, arrived: pa.Table) -> pa.Table:
        if not len(own):  # beyond the face, or a block without a cell
            return _schema(_STATE).empty_table()
        r = own.to_pylist()[0]
        shape, borders = (r["h"], r["w"]), {a["side"]: a["border"] for a in arrived.to_pylist()}
        masked, first = _bits(r["masked"], shape), "fixed" not in r
        if first:
            lengths = {s: shape[1] if s in "ns" else shape[0] for s in borders}
            begun = start_distances(masked, {s: np.unpackbits(np.frombuffer(v, np.uint8), count=lengths[s]).astype(bool) for s, v in borders.items()}, r["dy"], r["dx"])
            dist = np.where(begun < limit, begun, np.inf)
            r |= {"fixed": np.packbits(np.isfinite(begun)).tobytes(), **{f"in_{s}": None for s in _SIDES}, **{f"out_{s}": None for s in _SIDES}}
        else:
            dist = np.frombuffer(r["dist"]).reshape(shape) if r["dist"] else np.full(shape, np.inf)
            r |= {f"in_{s}": v for s, v in borders.items()}
        before = {s: _edge(dist, s) for s in _SIDES}
        if first or borders:
            free = ~masked & ~_bits(r["fixed"], shape)
            dist = relax(dist, {s: np.frombuffer(r[f"in_{s}"]) if r[f"in_{s}"] else None for s in _SIDES}, free, r["dy"], r["dx"], limit)
        for s in _SIDES:
            edge = _edge(dist, s)
            told = np.isfinite(edge).any() if first else (edge != before[s]).any()
            r[f"out_{s}"] = np.ascontiguousarray(edge).tobytes() if told else None
        r["dist"] = np.ascontiguousarray(dist).tobytes() if np.isfinite(dist).any() else b""
        return pa.Table.from_pylist([r], _schema(_STATE))

    key = ["face", "jb", "ib"]
    try:
        _packed(mask, spacing, block).write.parquet(f"{folder}/0")
        k, state = 0, spark.read.parquet(f"{folder}/0")
        while True:
            sent = _sent(state)
            if k and not sent.limit(1).count():
                break
            state.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(solve, _STATE).write.parquet(f"{folder}/{k + 1}")
            if k:
                remove(spark, f"{folder}/{k - 1}")
            k, state = k + 1, spark.read.parquet(f"{folder}/{k + 1}")

        def cells(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    shape = r["h"], r["w"]
                    jj, ii = np.nonzero(_bits(r["held"], shape))
                    dist = np.frombuffer(r["dist"]).reshape(shape)[jj, ii] if r["dist"] else np.full(len(jj), np.inf)
                    at = [pa.array((v + r[b] * block).astype(np.int32)) for v, b in ((jj, "jb"), (ii, "ib"))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(jj), r["face"], np.int32)), *at, pa.array(_bits(r["masked"], shape)[jj, ii]), pa.array(dist, mask=~np.isfinite(dist))], ["face", "j", "i", "masked", "km"])

        return state.select("face", "jb", "ib", "h", "w", "held", "masked", "dist").mapInArrow(cells, "face INT, j INT, i INT, masked BOOLEAN, km DOUBLE").checkpoint()
    finally:
        remove(spark, folder)
