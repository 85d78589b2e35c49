"""Extents in km, patch bounds, patch pixels and area downsampling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oceanloom.operators.stencil import AXES


_INDEX = "face INT, line INT, k ARRAY<INT>, d ARRAY<DOUBLE>"
_EXTENTS = "sample_id BIGINT, low INT, high INT, real_km DOUBLE"
#: Blocks that patches touch are broadcast up to this many.
MOST_BROADCAST = 200_000
BLOCK = 720


def line_index(grid: DataFrame, axis: str) -> DataFrame:
    """``face, line, k, d``: for each grid line along the axis its cells' places in order, and the km between the centres of each and the next.

    ``d`` is one shorter than ``k``, and NULL where a spacing is missing.  Lines of one cell have no distances.
    """
    spacing, other = {"i": "dxc", "j": "dyc"}[axis], AXES[axis]
    lines = grid.groupBy("face", F.col(other).alias("line")).agg(F.array_sort(F.collect_list(F.struct(F.col(axis).alias("k"), F.col(spacing).cast("double").alias("s")))).alias("c"))
    between = F.zip_with(F.expr("slice(c, 1, size(c) - 1)"), F.expr("slice(c, 2, size(c) - 1)"), lambda a, b: F.lit(0.5) * (a["s"] + b["s"]) / 1000.0)
    return lines.where("size(c) > 1").select("face", "line", F.col("c.k").alias("k"), between.alias("d"))


def _reach(d: np.ndarray, run: np.ndarray, km: float) -> int:
    """How many of the running sums of d stay below km; ``run`` is any running sum, from which the place is found by bisection.

    The sums are then formed from the first on, as the rule says, in the few places where rounding could matter.
    """
    near = int(np.searchsorted(run, run[0] - d[0] + km)) if len(d) else 0
    sums = np.cumsum(d[: near + 2])
    return int(np.count_nonzero(sums < km))


def line_extents(k: np.ndarray, d: np.ndarray, centres: np.ndarray, km: float) -> list[tuple[int, int, float | None]]:
    """``(low, high, real_km)`` of the cells at the places ``centres`` of one line; NaN in d is a missing distance."""
    gaps = np.flatnonzero(np.isnan(d))
    up, down = np.cumsum(np.nan_to_num(d)), np.cumsum(np.nan_to_num(d)[::-1])
    labels, out = k[:-1], []
    for c in centres:
        first, last = int(np.searchsorted(labels, c)), int(np.searchsorted(labels, c, "right"))  # distances from c upward, and those up to c
        to = int(gaps[np.searchsorted(gaps, first)]) if len(gaps) and gaps[-1] >= first else len(d)
        back = int(gaps[np.searchsorted(gaps, last) - 1]) + 1 if len(gaps) and gaps[0] < last else 0
        high = _reach(d[first:to], up[first:to], km)
        low = _reach(d[back:last][::-1], down[len(d) - last : len(d) - back], km)
        if low == last:
            low = high
        elif high == len(d) - first:
            high = low
        inside = d[np.searchsorted(labels, c - low) : np.searchsorted(labels, c + high - 1, "right")]
        real = None if low > c or np.isnan(inside).any() else float(np.cumsum(inside)[-1]) if len(inside) else 0.0
        out.append((low, high, real))
    return out


def extent(samples: DataFrame, grid: DataFrame, axis: str, km: float) -> DataFrame:
    """``sample_id, low, high, real_km``: cells to either side whose running spacing stays below ``km``.

    The low side counts from the centre cell downward, the high side from the centre cell upward.  A side that runs into
    the edge takes the other side's count: the low side is tested first, and only one of the two is replaced.
    The realised km leave the centre cell out on the low side; they are NULL where a spacing is missing.

    Only lines that a sample lies on are indexed, and each is searched once for all of its samples.
    """
    other = AXES[axis]
    wanted = samples.select("face", other).distinct()
    held = grid.join(F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted, ["face", other], "left_semi")
    return extent_on(samples, line_index(held, axis), axis, km)


def extent_on(samples: DataFrame, index: DataFrame, axis: str, km: float) -> DataFrame:
    """The same from an index that was built before."""

    def search(lines: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["sample_id", "low", "high", "real_km"]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
        if not len(lines) or not len(asked):
            return pa.table([pa.array([], t) for t in types], names)
        k, d = (lines.column(c)[0].values.to_numpy(zero_copy_only=False) for c in ("k", "d"))
        found = line_extents(k, d.astype(float), asked.column("c").to_numpy(), km)
        return pa.table([asked.column("sample_id"), *(pa.array(x, t) for x, t in zip(zip(*found, strict=True), types[1:], strict=True))], names)

    at = samples.select(F.col("sample_id").cast("bigint").alias("sample_id"), "face", F.col(AXES[axis]).alias("line"), F.col(axis).alias("c"))
    return index.groupBy("face", "line").cogroup(at.groupBy("face", "line")).applyInArrow(search, _EXTENTS)


def patch_bounds(samples: DataFrame, grid: DataFrame, km: float) -> DataFrame:
    """``sample_id, face, i_start, i_end, j_start, j_end, real_km_w, real_km_h, status``; bounds are inclusive.

    Status is ok, or the first edge that the patch crosses: i_low, i_high, j_low, j_high.
    """
    half = km / 2.0
    e = extent(samples, grid, "i", half).select("sample_id", F.col("low").alias("left"), F.col("high").alias("right"), F.col("real_km").alias("real_km_w"))
    n = extent(samples, grid, "j", half).select("sample_id", F.col("low").alias("down"), F.col("high").alias("up"), F.col("real_km").alias("real_km_h"))
    size = F.broadcast(grid.groupBy("face").agg((F.max("i") + 1).alias("ni"), (F.max("j") + 1).alias("nj")))  # a row per face
    b = samples.select("sample_id", "face", "j", "i").join(e, "sample_id").join(n, "sample_id").join(size, "face")
    b = b.select(
        "sample_id", "face", (F.col("i") - F.col("left")).alias("i_start"), (F.col("i") + F.col("right")).alias("i_end"),
        (F.col("j") - F.col("down")).alias("j_start"), (F.col("j") + F.col("up")).alias("j_end"), "real_km_w", "real_km_h", "ni", "nj",
    )
    status = (
        F.when(F.col("i_start") < 0, "i_low").when(F.col("i_end") > F.col("ni") - 1, "i_high")
        .when(F.col("j_start") < 0, "j_low").when(F.col("j_end") > F.col("nj") - 1, "j_high").otherwise("ok")
    )
    return b.withColumn("status", status).drop("ni", "nj")


def _touched(patches: DataFrame, block: int) -> DataFrame:
    """The accepted patches, one row for each block of cells that they touch."""
    ok = patches.where("status = 'ok'") if "status" in patches.columns else patches
    blocks = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / block).cast("int"), F.floor(F.col(b) / block).cast("int")))
    return ok.select("sample_id", "face", "i_start", "i_end", "j_start", "j_end").withColumn("jb", blocks("j_start", "j_end")).withColumn("ib", blocks("i_start", "i_end"))


def _in_blocks(cells: DataFrame, block: int) -> DataFrame:
    """The cells with the block that they lie in; a store that was written in blocks has it as partition columns."""
    if {"jb", "ib"} <= set(cells.columns):
        return cells
    return cells.withColumns({b: F.floor(F.col(c) / block).cast("int") for b, c in (("jb", "j"), ("ib", "i"))})


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def patch_pixels(cells: DataFrame, patches: DataFrame, channels: list[str], with_size: bool = False, block: int = BLOCK) -> DataFrame:
    """``sample_id, channel, y, x, v``: every cell of every accepted patch, channels in the order given; missing stays NULL.

    Patches are looked up by the blocks of cells that they touch.  These are broadcast up to MOST_BROADCAST, so the grid is
    neither shuffled nor, where it is stored in blocks of this size, read beyond them.  Cells that the grid lacks are filled in
    among the pixels alone.  With ``with_size`` each row also has its patch's ``h, w``.
    """
    touched = _touched(patches, block)
    values = F.array(*[F.col(c).cast("float") for c in channels]).alias("_v")
    met = _in_blocks(cells, block).select("face", "jb", "ib", "j", "i", values).join(_few(touched), ["face", "jb", "ib"])
    got = met.where("j BETWEEN j_start AND j_end AND i BETWEEN i_start AND i_end").select("sample_id", "j", "i", "_v")
    ok = patches.where("status = 'ok'") if "status" in patches.columns else patches
    size = [(F.col("j_end") - F.col("j_start") + 1).alias("h"), (F.col("i_end") - F.col("i_start") + 1).alias("w")] if with_size else []
    rows = ok.select("sample_id", "i_start", "i_end", "j_start", *size, F.explode(F.sequence("j_start", "j_end")).alias("j"))
    size = ["h", "w"] if with_size else []
    want = rows.select("sample_id", "i_start", "j_start", *size, "j", F.explode(F.sequence("i_start", "i_end")).alias("i"))
    filled = want.join(got, ["sample_id", "j", "i"], "left")
    values = F.coalesce("_v", F.array(*[F.lit(None).cast("float")] * len(channels)))
    each = filled.select("sample_id", *size, (F.col("j") - F.col("j_start")).alias("y"), (F.col("i") - F.col("i_start")).alias("x"), F.posexplode(values).alias("channel", "v"))
    return each.select("sample_id", "channel", "y", "x", "v", *size)


def window_sums(area: np.ndarray, first_j: int, first_i: int, rows: tuple[np.ndarray, np.ndarray], columns: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sums of a block over windows, from its summed-area table: four lookups each.

    ``area[..., j, i]`` is the sum of the block's cells before row j and column i; windows are half-open, in cells of the face,
    and count as far as they lie in the block.
    """
    (a, b), (c, d) = ([np.clip(x - first, 0, n) for x in xs] for xs, first, n in ((rows, first_j, area.shape[-2] - 1), (columns, first_i, area.shape[-1] - 1)))
    b, d = np.maximum(a, b), np.maximum(c, d)
    at = lambda y, x: area[..., y[:, None], x[None, :]]
    return at(b, d) - at(a, d) - at(b, c) + at(a, c)


def pooled(cells: DataFrame, patches: DataFrame, channels: list[str], target: int = 64, strict: bool = False, block: int = BLOCK) -> DataFrame:
    """``sample_id, channel, y, x, v``: adaptive means of every accepted patch, ``target x target``, as ``downsample`` gives them of its pixels.

    Each touched block makes a summed-area table of its values and one of its present cells, once for all patches in it, and
    gives each output pixel's part; the parts of blocks are added.  No row is made of an input pixel.  A window with a cell that
    is missing is missing.  Patches smaller than the target are left out, or raise ``ValueError`` with ``strict``.
    """
    ok = patches.where("status = 'ok'") if "status" in patches.columns else patches
    big = (F.col("j_end") - F.col("j_start") + 1 >= target) & (F.col("i_end") - F.col("i_start") + 1 >= target)
    if strict and ok.where(~big).limit(1).count():
        raise ValueError(f"an image is smaller than {target} x {target}")
    touched = _touched(ok.where(big), block)
    keys = ["face", "jb", "ib"]
    held = _in_blocks(cells, block).select(*keys, "j", "i", *[F.col(c).cast("float").cast("double").alias(f"_v{k}") for k, c in enumerate(channels)])
    held = held.join(_few(touched.select(*keys).distinct()), keys, "left_semi")
    steps = np.arange(target)

    def sums(own: pa.Table, asked: pa.Table) -> pa.Table:
        names, types = ["sample_id", "channel", "y", "x", "s", "have", "want"], (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
        if not len(own) or not len(asked):
            return pa.table([pa.array([], t) for t in types], names)
        j, i = own.column("j").to_numpy(), own.column("i").to_numpy()
        first_j, first_i = int(j.min()), int(i.min())
        values = np.full((len(channels), int(j.max()) - first_j + 1, int(i.max()) - first_i + 1), np.nan)
        for k in range(len(channels)):
            values[k, j - first_j, i - first_i] = own.column(f"_v{k}").to_numpy(zero_copy_only=False).astype(float)
        there = ~np.isnan(values)
        area, present = (np.pad(x.cumsum(-2).cumsum(-1), ((0, 0), (1, 0), (1, 0))) for x in (np.where(there, values, 0.0), there.astype(np.int64)))
        out = []
        for r in asked.to_pylist():
            h, w = r["j_end"] - r["j_start"] + 1, r["i_end"] - r["i_start"] + 1
            (y0, y1), (x0, x1) = ((first + steps * n // target, first + ((steps + 1) * n + target - 1) // target) for first, n in ((r["j_start"], h), (r["i_start"], w)))
            s, have = (window_sums(t, first_j, first_i, (y0, y1), (x0, x1)) for t in (area, present))
            want = np.broadcast_to(((y1 - y0)[:, None] * (x1 - x0)[None, :]), have.shape)
            c, y, x = np.nonzero(have > 0)
            out.append((np.full(len(c), r["sample_id"]), c, y, x, s[c, y, x], have[c, y, x], want[c, y, x]))
        return pa.table([pa.array(np.concatenate(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    parts = held.groupBy(*keys).cogroup(touched.groupBy(*keys)).applyInArrow(sums, "sample_id BIGINT, channel INT, y INT, x INT, s DOUBLE, have BIGINT, want BIGINT")
    found = parts.groupBy("sample_id", "channel", "y", "x").agg(F.sum("s").alias("s"), F.sum("have").alias("have"), F.max("want").alias("want"))
    mean = F.when(F.col("have") == F.col("want"), F.col("s") / F.col("want")).cast("float")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    whole = ok.where(big).select("sample_id").withColumn("channel", up_to(len(channels))).withColumn("y", up_to(target)).withColumn("x", up_to(target))  # also windows without a cell
    return whole.join(found, ["sample_id", "channel", "y", "x"], "left").select("sample_id", "channel", "y", "x", mean.alias("v"))


def downsample(pixels: DataFrame, target: int = 64, strict: bool = False) -> DataFrame:
    """Adaptive mean to ``target x target``: output row k covers input rows ``floor(kH/T)`` to ``ceil((k+1)H/T) - 1``.

    A window with a missing value is missing.  Images smaller than the target are left out, or raise ``ValueError`` with ``strict``.
    Sizes are taken from ``h, w`` where the pixels have them, or else found from the pixels.
    """
    if not {"h", "w"} <= set(pixels.columns):
        pixels = pixels.join(pixels.groupBy("sample_id").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w")), "sample_id")
    if strict and pixels.where((F.col("h") < target) | (F.col("w") < target)).limit(1).count():
        raise ValueError(f"an image is smaller than {target} x {target}")
    big = pixels.where((F.col("h") >= target) & (F.col("w") >= target))

    def targets(at: str, n: str) -> Column:
        first = F.expr(f"CAST({at} * {target} div {n} AS INT)")
        last = F.expr(f"CAST((({at} + 1) * {target} + {n} - 1) div {n} - 1 AS INT)")
        return F.explode(F.sequence(first, last))

    spread = big.withColumn("ky", targets("y", "h")).withColumn("kx", targets("x", "w"))
    pooled = spread.groupBy("sample_id", "channel", "ky", "kx").agg(F.avg(F.col("v").cast("double")).alias("m"), F.count("v").alias("_have"), F.count("*").alias("_all"))
    return pooled.select("sample_id", "channel", F.col("ky").alias("y"), F.col("kx").alias("x"), F.when(F.col("_have") == F.col("_all"), F.col("m")).cast("float").alias("v"))


def tensors(pixels: DataFrame) -> DataFrame:
    """``sample_id, c, h, w, data``: one row-major, channel-first array per patch.  A patch has a fixed size in km, so the group is small."""
    packed = pixels.groupBy("sample_id").agg(
        (F.max("channel") + 1).alias("c"), (F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"), F.array_sort(F.collect_list(F.struct("channel", "y", "x", "v"))).alias("_p")
    )
    return packed.select("sample_id", "c", "h", "w", F.transform("_p", lambda p: p["v"]).alias("data"))


def tensor_pixels(images: DataFrame) -> DataFrame:
    """The inverse of ``tensors``."""
    at = images.select("sample_id", "h", "w", F.posexplode("data").alias("p", "v"))
    return at.select("sample_id", F.expr("CAST(p div (h * w) AS INT)").alias("channel"), F.expr("CAST(p div w % h AS INT)").alias("y"), F.expr("CAST(p % w AS INT)").alias("x"), "v")
