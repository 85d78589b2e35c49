"""Faces joined at their sides, distances on blocks, chunked stores, block stores and pooling, against plain arrays."""

import base64
import json
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oceanloom.operators import distance, halo, patches, seams, stencil
from oceanloom.sources import blocks, chunks

N = 5
#: Where the cell (j, i) of a turned face lies: x and y of a face of N x N cells, for all eight turns and reflections.
TURNS = [(a, b, swap) for a in (1, -1) for b in (1, -1) for swap in (False, True)]


def placed(turn, j, i):
    a, b, swap = turn
    x, y = (j, i) if swap else (i, j)
    return (x if a > 0 else N - 1 - x), (y if b > 0 else N - 1 - y)


def axes(turn):
    """The plane's directions of a face's i and j axis."""
    o, i, j = np.array(placed(turn, 0, 0)), np.array(placed(turn, 0, 1)), np.array(placed(turn, 1, 0))
    return i - o, j - o


OFFSET = {"i_low": (-N, 0), "i_high": (N, 0), "j_low": (0, -N), "j_high": (0, N)}


def link_of(turn, side):
    """The other face's side at the seam, and whether the two run against each other, from where their cells lie."""
    edge = {"i_low": lambda x, y: x == N - 1, "i_high": lambda x, y: x == 0, "j_low": lambda x, y: y == N - 1, "j_high": lambda x, y: y == 0}[side]
    cells = {"i_low": lambda k: (k, 0), "i_high": lambda k: (k, N - 1), "j_low": lambda k: (0, k), "j_high": lambda k: (N - 1, k)}
    for to, at in cells.items():
        places = [placed(turn, *at(k)) for k in range(N)]
        if all(edge(x, y) for x, y in places):
            run = [y if side.startswith("i") else x for x, y in places]
            return to, run[0] > run[-1]
    raise AssertionError


def plane(x, y):
    return 2.0 * x + 3.0 * y


def two_faces(spark, turn, side):
    ox, oy = OFFSET[side]
    ai, aj = axes(turn)
    rows = []
    for j in range(N):
        for i in range(N):
            x, y = placed(turn, j, i)
            vector = np.array([x + ox + 0.25, 10.0 - y - oy])
            rows.append((1, j, i, plane(x + ox, y + oy), 1.0, 1.0, 1.0, 0.0, float(vector @ ai), float(vector @ aj)))
            rows.append((0, j, i, plane(i, j), 1.0, 1.0, 1.0, 0.0, i + 0.25, 10.0 - j))
    return spark.createDataFrame(rows, "face INT, j INT, i INT, s DOUBLE, dxc DOUBLE, dyc DOUBLE, cs DOUBLE, sn DOUBLE, u DOUBLE, v DOUBLE")


@pytest.mark.parametrize("side", seams.SIDES)
def test_ghosts_of_every_turn(spark, side):
    """A plane field, and a vector field given in each face's own axes, go on across a seam however the other face is turned."""
    whole, links = None, []
    for k, turn in enumerate(TURNS):
        df = two_faces(spark, turn, side).withColumn("face", F.col("face") + 2 * k)
        whole = df if whole is None else whole.unionByName(df)
        to, against = link_of(turn, side)
        links.append((2 * k, side, 2 * k + 1, to, against))
    table = seams.face_links(spark, links)
    got = seams.turned(seams.ghosts(whole, table, ["s", "u", "v"]), "u", "v").where("face % 2 = 0").collect()
    assert len(got) == len(TURNS) * N
    for r in got:
        assert (r.s, r.u, r.v) == (plane(r.i, r.j), r.i + 0.25, 10.0 - r.j), r
        assert {"i_low": r.i == -1, "i_high": r.i == N, "j_low": r.j == -1, "j_high": r.j == N}[side]
    flat = seams.linked_gradient(whole, "s", table).where("face % 2 = 0")
    ends = {"i_low": "i < 4 AND j BETWEEN 1 AND 3", "i_high": "i > 0 AND j BETWEEN 1 AND 3", "j_low": "j < 4 AND i BETWEEN 1 AND 3", "j_high": "j > 0 AND i BETWEEN 1 AND 3"}[side]
    assert {(round(r.zonal, 9), round(r.merid, 9)) for r in flat.where(ends).collect()} == {(2.0, 3.0)}


def test_four_faces_around_a_point(spark):
    """Two by two faces, each turned another way: inside the joined square the gradient is the plane's, rotated by each face's own angle."""
    turns = {(0, 0): (1, 1, False), (1, 0): (-1, 1, True), (0, 1): (-1, -1, False), (1, 1): (1, -1, True)}
    rows, links = [], []
    for f, ((gx, gy), t) in enumerate(turns.items()):
        (ax, ay), (bx, by) = axes(t)
        assert ax * by - ay * bx == 1
        for j in range(N):
            for i in range(N):
                x, y = placed(t, j, i)
                rows.append((f, j, i, plane(x + N * gx, y + N * gy), 1.0, 1.0, float(ax), float(ay), x + N * gx, y + N * gy))

    def side_at(t, edge):
        for to, at in {"i_low": lambda k: (k, 0), "i_high": lambda k: (k, N - 1), "j_low": lambda k: (0, k), "j_high": lambda k: (N - 1, k)}.items():
            places = [placed(t, *at(k)) for k in range(N)]
            if all(edge(x, y) for x, y in places):
                return to, [x + y for x, y in places]
        raise AssertionError

    keys = list(turns)
    for a, b, out, back in (((0, 0), (1, 0), lambda x, y: x == N - 1, lambda x, y: x == 0), ((0, 1), (1, 1), lambda x, y: x == N - 1, lambda x, y: x == 0), ((0, 0), (0, 1), lambda x, y: y == N - 1, lambda x, y: y == 0), ((1, 0), (1, 1), lambda x, y: y == N - 1, lambda x, y: y == 0)):
        (sa, ra), (sb, rb) = side_at(turns[a], out), side_at(turns[b], back)
        links.append((keys.index(a), sa, keys.index(b), sb, (ra[0] < ra[-1]) != (rb[0] < rb[-1])))
    df = spark.createDataFrame(rows, "face INT, j INT, i INT, s DOUBLE, dxc DOUBLE, dyc DOUBLE, cs DOUBLE, sn DOUBLE, x INT, y INT")
    got = seams.linked_gradient(df, "s", seams.face_links(spark, links)).where(f"x BETWEEN 1 AND {2 * N - 2} AND y BETWEEN 1 AND {2 * N - 2}").collect()
    assert len(got) == (2 * N - 2) ** 2
    assert {(round(r.zonal, 9), round(r.merid, 9)) for r in got} == {(2.0, 3.0)}


def test_without_links_the_gradient_is_the_plain_one(spark):
    df = two_faces(spark, TURNS[0], "i_high")
    none = spark.createDataFrame([], seams.LINKS)
    cols = ["face", "j", "i", "zonal", "merid"]
    assert sorted(map(str, seams.linked_gradient(df, "s", none).select(cols).collect())) == sorted(map(str, stencil.tracer_gradient(df, "s").select(cols).collect()))
    with pytest.raises(ValueError):
        seams.face_links(spark, [(0, "north", 1, "i_low", False)])
    with pytest.raises(ValueError):
        seams.face_links(spark, [(0, "i_low", 1, "i_low", False), (0, "i_low", 2, "i_low", False)])
    assert seams.ghosts(df.where("false"), seams.face_links(spark, [(0, "i_low", 1, "i_low", False)]), ["s"]).count() == 0


def one_array(masked, dy, dx, limit):
    """The whole face relaxed cell by cell, in both directions, until nothing changes."""
    h, w = masked.shape
    d = np.full((h, w), np.inf)
    fixed = np.zeros((h, w), bool)
    near = lambda j, i: [(j - 1, i, dy), (j + 1, i, dy), (j, i - 1, dx), (j, i + 1, dx)]
    inside = lambda j, i: 0 <= j < h and 0 <= i < w
    for j in range(h):
        for i in range(w):
            if not masked[j, i]:
                steps = {s for y, x, s in [(y, x, "y" if x == i else "x") for y, x, _ in near(j, i)] if inside(y, x) and masked[y, x]}
                if steps:
                    d[j, i] = sum(4.0 / (dy if s == "y" else dx) ** 2 for s in steps) ** -0.5
                    fixed[j, i] = True
    changed = True
    while changed:
        changed = False
        for order in (1, -1):
            for j in range(h)[::order]:
                for i in range(w)[::order]:
                    if masked[j, i] or fixed[j, i]:
                        continue
                    a = min((d[y, x] for y, x in ((j - 1, i), (j + 1, i)) if inside(y, x)), default=np.inf)
                    b = min((d[y, x] for y, x in ((j, i - 1), (j, i + 1)) if inside(y, x)), default=np.inf)
                    t = min(a + dy, b + dx)
                    if np.isfinite(a) and np.isfinite(b):
                        p, q = 1 / dy**2, 1 / dx**2
                        root = (p * a + q * b) ** 2 - (p + q) * (p * a * a + q * b * b - 1)
                        if root >= 0 and (two := (p * a + q * b + root**0.5) / (p + q)) >= max(a, b):
                            t = two
                    if t < d[j, i]:
                        d[j, i], changed = t, True
    return np.where(d < limit, d, np.inf)


@pytest.mark.parametrize("block", [7, 64])
def test_distance_on_blocks_equals_one_array(spark, block):
    rng = np.random.default_rng(3)
    h, w, dy, dx = 40, 33, 0.9, 1.3
    faces = {0: rng.random((h, w)) < 0.01, 1: np.zeros((h, w), bool), 2: np.ones((h, w), bool), 3: np.zeros((h, w), bool)}
    faces[3][10:30, 16] = faces[3][10, 5:16] = faces[3][29, 5:16] = True  # a bay that a front has to turn into
    rows = [(f, j, i, bool(m[j, i])) for f, m in faces.items() for j in range(h) for i in range(w) if (f, j, i) != (0, 20, 20)]
    mask = spark.createDataFrame(rows, "face INT, j INT, i INT, masked BOOLEAN")
    spacing = spark.createDataFrame([(f, dx, dy) for f in faces], "face INT, dx_km DOUBLE, dy_km DOUBLE")
    faces[0][20, 20] = True  # a missing cell counts as masked
    got = distance.distances(mask, spacing, 9.0, block).collect()
    assert len(got) == len(rows)
    want = {f: one_array(m, dy, dx, 9.0) for f, m in faces.items()}
    for r in got:
        d = want[r.face][r.j, r.i]
        assert r.masked == faces[r.face][r.j, r.i] and (r.km is None) == (not np.isfinite(d)) and (r.km is None or abs(r.km - d) < 1e-9), r
    assert distance.distances(mask.where("false"), spacing, 9.0, block).count() == 0


def test_blocks_never_hold_more_than_their_cells(spark):
    mask = spark.range(100 * 50).select(F.lit(0).alias("face"), (F.col("id") / 50).cast("int").alias("j"), (F.col("id") % 50).cast("int").alias("i"), (F.col("id") == 30).alias("masked"))
    spacing = spark.createDataFrame([(0, 1.0, 1.0)], "face INT, dx_km DOUBLE, dy_km DOUBLE")
    packed = distance._packed(mask, spacing, 16).collect()
    assert len(packed) == 7 * 4 and max(r.h * r.w for r in packed) == 256 and sum(r.h * r.w for r in packed) == 5000


def store(spark, tmp_path, codec="zlib"):
    df = spark.range(2 * 2 * 40 * 30).select(
        (F.col("id") % 2 * 144 + 10000).alias("iter"), (F.floor(F.col("id") / 2) % 2 * 3).cast("int").alias("face"), (F.floor(F.col("id") / 4) % 40).cast("int").alias("j"), F.floor(F.col("id") / 160).cast("int").alias("i"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 0.5).alias("Theta"), (F.col("id") * 2.0).alias("Salt"),
    )
    chunks.write_chunks(df, str(tmp_path / "store"), ["Theta", "Salt"], block=16, codec=codec)
    return df, str(tmp_path / "store")


@pytest.mark.parametrize("codec", ["zlib", None])
def test_chunks_round_trip(spark, tmp_path, codec):
    df, path = store(spark, tmp_path, codec)
    got = chunks.read_chunks(spark, path)
    assert got.columns == ["iter", "face", "j", "i", "Salt", "Theta"] and got.rdd.getNumPartitions() == 4 * 3 * 2
    assert sorted(map(tuple, got.select(df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert chunks.read_chunks(spark, path, faces=[]).count() == chunks.read_chunks(spark, path, faces=[9]).count() == chunks.read_chunks(spark, path, iterations=[1]).count() == chunks.read_chunks(spark, path, iterations=[]).count() == 0
    assert chunks.read_chunks(spark, path, variables=["Salt"]).columns[4:] == ["Salt"]


def test_only_touched_chunks_are_opened(spark, tmp_path):
    """Chunk objects and reference files that the choice leaves out are deleted: the rest still reads, anything wider doesn't."""
    df, path = store(spark, tmp_path)
    for f in os.listdir(f"{path}/chunks"):
        if not f.startswith("it10144_f3_1_"):
            os.remove(f"{path}/chunks/{f}")
    for f in os.listdir(path):
        if f.endswith("iter_10000.json"):
            os.remove(f"{path}/{f}")
    got = chunks.read_chunks(spark, path, faces=[3], j=(17, 30))
    assert sorted(map(tuple, got.select(df.columns).collect()), key=str) == sorted(map(tuple, df.where("iter = 10144 AND face = 3 AND j BETWEEN 17 AND 30").collect()), key=str)
    with pytest.raises(Exception, match="it10144_f3_0_"):
        chunks.read_chunks(spark, path, faces=[3], j=(15, 30)).count()
    spark.conf.set(chunks.PUSHDOWN, "true")
    try:
        pushed = chunks.read_chunks(spark, path).where("face = 3 AND j >= 16 AND j < 32 AND i < 16 AND iter IN (10144, 5)")
        assert pushed.count() == 16 * 16
    finally:
        spark.conf.unset(chunks.PUSHDOWN)


def test_reference_files_as_they_occur(spark, tmp_path):
    """Chunks in the file itself, missing chunks, other dimensions and edges, fill values, templates, whole objects, column order."""
    a = np.arange(20, dtype=">f4").reshape(4, 5)
    padded = lambda x: np.pad(x, ((0, 0), (0, 1)))
    (tmp_path / "whole.bin").write_bytes(padded(a)[:, 3:].astype(">f4").tobytes())
    meta = lambda **k: json.dumps({"shape": [1, 4, 5], "chunks": [1, 4, 3], "dtype": ">f4", "order": "C", "compressor": None, "fill_value": 7.0, "filters": None} | k)
    refs = {
        "Eta/.zarray": meta(), "Eta/.zattrs": json.dumps({"_ARRAY_DIMENSIONS": ["time", "j", "i"]}), "Eta/0.0.0": "base64:" + base64.b64encode(a[:, :3].tobytes()).decode(), "Eta/0.0.1": ["{{u}}/whole.bin"],
        "U/.zarray": meta(shape=[1, 1, 4, 5], chunks=[1, 1, 2, 5], dtype="<f8", compressor={"id": "zlib"}, fill_value=None, order="F"), "U/.zattrs": {"_ARRAY_DIMENSIONS": ["time", "k", "j", "i_g"]},
        "U/0.0.1.0": "base64:" + base64.b64encode(zlib.compress(np.arange(10.0).reshape(2, 5).tobytes("F"))).decode(),
        "i/.zarray": meta(shape=[5], chunks=[5]), "i/.zattrs": json.dumps({"_ARRAY_DIMENSIONS": ["i"]}), ".zgroup": "{}",
    }
    (tmp_path / "x_f2_k0_iter_5.json").write_text(json.dumps({"version": 1, "templates": {"u": str(tmp_path)}, "refs": refs}))
    got = {(r.j, r.i): (r.Eta, r.U) for r in chunks.read_chunks(spark, str(tmp_path)).where("iter = 5 AND face = 2").collect()}
    assert got == {(j, i): (None if a[j, i] == 7 else float(a[j, i]), float((j - 2) * 5 + i) if j >= 2 else None) for j in range(4) for i in range(5)}
    with pytest.raises(ValueError, match="unknown codec"):
        chunks.decompressed(b"", {"id": "blosc"})
    import pyarrow as pa
    import zstandard

    for n in (3, 300, 70_000):
        assert chunks.decompressed(zstandard.compress(b"x" * n), {"id": "zstd"}) == b"x" * n
    assert chunks.open_store("s3://bucket/a/b", {"endpoint": "http://localhost:1", "region": "nowhere"})[1] == "bucket/a/b" and pa is not None


def field(spark, nj, ni, holes=()):
    rows = [(0, j, i, float((j * 37 + i * 11) % 101) / 7, float(j - i)) for j in range(nj) for i in range(ni) if (j, i) not in holes]
    return spark.createDataFrame(rows, "face INT, j INT, i INT, a DOUBLE, b DOUBLE")


PATCHES = "sample_id BIGINT, face INT, i_start INT, i_end INT, j_start INT, j_end INT, status STRING"


def test_images_of_64_by_64_equal_plain_means(spark):
    cells = field(spark, 150, 140, holes={(30, 30), (149, 139)}).withColumn("a", F.when(~((F.col("j") == 90) & (F.col("i") == 100)), F.col("a")))
    rows = [(1, 0, 3, 90, 5, 100, "ok"), (2, 0, 60, 123, 60, 123, "ok"), (3, 0, 0, 139, 0, 149, "ok"), (4, 0, 0, 62, 0, 80, "ok"), (5, 0, 0, 99, 0, 99, "i_low")]
    df = spark.createDataFrame(rows, PATCHES)
    full = {n: np.full((150, 140), np.nan) for n in ("a", "b")}
    for r in cells.collect():
        full["a"][r.j, r.i] = np.nan if r.a is None else np.float32(r.a)
        full["b"][r.j, r.i] = np.float32(r.b)
    got = {(r.sample_id, r.channel, r.y, r.x): r.v for r in patches.pooled(cells, df, ["a", "b"], 64, block=48).collect()}
    assert len(got) == 3 * 2 * 64 * 64
    for s, _, i0, i1, j0, j1, _ in rows[:3]:
        h, w = j1 - j0 + 1, i1 - i0 + 1
        for c, n in enumerate(("a", "b")):
            for y in range(64):
                for x in range(64):
                    want = full[n][j0 + y * h // 64 : j0 + -(-(y + 1) * h // 64), i0 + x * w // 64 : i0 + -(-(x + 1) * w // 64)].mean()
                    v = got[s, c, y, x]
                    assert (v is None) == np.isnan(want) and (v is None or abs(v - want) < 1e-5)
    with pytest.raises(ValueError):
        patches.pooled(cells, df, ["a"], 64, strict=True)
    assert patches.pooled(cells.where("false"), df, ["a"], 64).where("v IS NOT NULL").count() == 0
    assert patches.pooled(cells, df.where("false"), ["a"], 64).count() == 0


def test_pixels_come_from_touched_blocks_alone(spark, tmp_path):
    cells = field(spark, 60, 60, holes={(12, 13)})
    blocks.write_blocks(cells, str(tmp_path / "b"), 10)
    held, df = blocks.read_blocks(spark, str(tmp_path / "b")), spark.createDataFrame([(1, 0, 8, 14, 11, 15, "ok"), (2, 0, 50, 59, 50, 59, "ok")], PATCHES)
    pixels = patches.patch_pixels(held, df, ["a", "b"], block=10)
    got = {(r.sample_id, r.channel, r.y, r.x): r.v for r in pixels.collect()}
    assert len(got) == 2 * (5 * 7 + 100) and got[1, 0, 1, 5] is None and got[1, 1, 0, 0] == 11.0 - 8
    same = {(r.sample_id, r.channel, r.y, r.x): r.v for r in patches.patch_pixels(cells, df, ["a", "b"], block=10).collect()}
    assert got == same
    plan = pixels._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :].split("\n")[0]
    assert "dynamicpruning" in scan and "SortMergeJoin" not in plan[: plan.index("FileScan")].split("BroadcastHashJoin")[-1]
    # Blocks that no patch touches are deleted, and are not missed.
    for jb in range(6):
        for ib in range(6):
            if (jb, ib) not in {(1, 0), (1, 1), (5, 5)}:
                for f in (tmp_path / "b" / "face=0" / f"jb={jb}" / f"ib={ib}").iterdir():
                    f.write_bytes(b"")
    read = spark.read.schema("face INT, j INT, i INT, a DOUBLE, b DOUBLE, jb INT, ib INT").parquet(str(tmp_path / "b"))
    assert {(r.sample_id, r.channel, r.y, r.x): r.v for r in patches.patch_pixels(read, df, ["a", "b"], block=10).collect()} == same


def plain_extent(k, d, c, km):
    labels = k[:-1]
    high = [x for q, x in zip(labels, d, strict=True) if q >= c]
    low = [x for q, x in zip(labels, d, strict=True) if q <= c][::-1]

    def count(side):
        total, n = 0.0, 0
        for x in side:
            total += x
            if not total < km:
                break
            n += 1
        return n

    left, right = count(low), count(high)
    if left == len(low):
        left = right
    elif right == len(high):
        right = left
    inside = [x for q, x in zip(labels, d, strict=True) if c - left <= q <= c + right - 1]
    return left, right, None if left > c or any(np.isnan(inside)) else sum(inside)


def test_line_search_equals_a_loop():
    """Uneven spacing, gaps in it, missing cells, sums that meet the limit exactly, short lines."""
    rng = np.random.default_rng(4)
    for n in (2, 3, 17, 400):
        for trial in range(12):
            k = np.sort(rng.choice(n * (2 if trial % 3 == 0 else 1), n, replace=False))
            d = np.full(n - 1, 0.1) if trial % 4 == 1 else rng.uniform(0.5, 1.5, n - 1)
            if trial % 4 == 2:
                d[rng.random(n - 1) < 0.1] = np.nan
            for km in (0.3, 0.7, 2.0, 6.25, 1e9):
                for c, got in zip(k, patches.line_extents(k, d, k, km), strict=True):
                    want = plain_extent(k, d, c, km)
                    assert got[:2] == want[:2] and (got[2] is None) == (want[2] is None) and (got[2] is None or abs(got[2] - want[2]) < 1e-9), (n, trial, km, c, got, want)


def test_extents_without_windows(spark):
    g = spark.range(400).select(F.lit(0).alias("face"), F.floor(F.col("id") / 20).cast("int").alias("j"), (F.col("id") % 20).cast("int").alias("i"), F.lit(1000.0).alias("dxc"), F.lit(1000.0).alias("dyc"))
    s = spark.createDataFrame([(k, 0, k % 20, (k * 7) % 20) for k in range(60)], "sample_id BIGINT, face INT, j INT, i INT")
    plan = patches.extent(s, g, "j", 3.5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Explode" not in plan
    index = patches.line_index(g, "i")
    assert sorted(map(tuple, patches.extent_on(s, index, "i", 3.5).collect())) == sorted(map(tuple, patches.extent(s, g, "i", 3.5).collect()))
    assert patches.extent(s.where("false"), g, "i", 3.5).count() == 0


def test_marched_halo_goes_around_land(spark):
    """Behind a wall the straight distance is short, and the front's way is long; both masks agree on open coasts."""
    rows = [(0, j, i, j == 10 and i == 10) for j in range(24) for i in range(24)]
    mask = spark.createDataFrame(rows, "face INT, j INT, i INT, masked BOOLEAN")
    g = mask.select("face", "j", "i", F.lit(1000.0).alias("dxc"), F.lit(1000.0).alias("dyc"))
    a, b = ({(r.j, r.i) for r in f(mask, g, 3.0).where("retained").collect()} for f in (halo.marched, halo.euclid))
    assert a <= b | a and len(a ^ b) < 12 and (10, 10) not in a


def test_blocks_of_one_store_pass_unshuffled(spark, tmp_path):
    from oceanloom.sources import readers

    rows = [(10, f, j, i, float(100 * f + j + i)) for f in (1, 2) for j in range(20) for i in range(20)]
    df = spark.createDataFrame(rows, "iter BIGINT, face INT, j INT, i INT, theta DOUBLE")
    readers.write_partitioned(df.where("face = 1"), f"{tmp_path}/a", 10)
    readers.write_partitioned(df.where("face = 2"), f"{tmp_path}/b", 10)
    readers.write_partitioned(df.where("face = 2 AND j >= 10").withColumn("theta", F.lit(-1.0)), f"{tmp_path}/c", 10)
    apart = readers.read_snapshots(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], 10, block=10)
    assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString() and apart.count() == 800
    both = readers.read_snapshots(spark, [f"{tmp_path}/a", f"{tmp_path}/c", f"{tmp_path}/b"], 10, block=10)
    got = {(r.face, r.j, r.i): r.theta for r in both.collect()}
    assert got == {(f, j, i): -1.0 if f == 2 and j >= 10 else v for _, f, j, i, v in rows} and both.count() == 800
    extents = {(r.face, r.jb, r.ib): (r.first, r.n_stores) for r in readers.store_extents([readers.read_snapshot(spark, f"{tmp_path}/{s}", 10) for s in "acb"], 10).collect()}
    assert extents[2, 1, 0] == (1, 2) and extents[2, 0, 1] == (2, 1) and extents[1, 1, 1] == (0, 1) and len(extents) == 8
    assert readers.read_snapshots(spark, [f"{tmp_path}/a"], 10).count() == 400


@pytest.mark.parametrize("n", [50, 2000, 3990, 9999])
def test_samples_by_threshold_equal_sorting(spark, n):
    from oceanloom.operators import sampling

    df = spark.range(4000).select((F.col("id") % 13).cast("int").alias("face"), F.floor(F.col("id") / 13).cast("int").alias("j"), F.lit(0).alias("i"), (F.col("id") % 97 / 10).alias("v"))
    whole = sampling.weighted_sample(df, n, 0.5, seed=3, strict=False)
    parted = sampling.weighted_sample(df, n, 0.5, seed=3, strict=False, together=17)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parted.collect())) and whole.count() == min(n, 4000)


def test_summaries_bound_the_error_of_ranks(spark):
    from oceanloom.operators import summaries

    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(size=20_000), np.round(rng.normal(size=10_000), 1), rng.exponential(size=10_000) ** 4])
    df = spark.createDataFrame([(k % 3, k % 5, k % 200, k // 200, float(v)) for k, v in enumerate(values.tolist())] + [(0, 0, 0, 0, None)], "iter INT, face INT, j INT, i INT, v DOUBLE")
    size, shares = 100, [0.001, 0.25, 0.5, 0.99]
    stored = summaries.summarise(df, "v", ["iter", "face"], size, 64).cache()
    assert stored.count() <= 15 * size and stored.agg(F.sum("weight")).first()[0] == len(values)
    for by in ([], ["iter"], ["face"]):
        merged = summaries.merge(stored, by, size)
        assert merged.agg(F.sum("weight")).first()[0] == len(values)
        for r in summaries.quantiles(merged, shares, by).collect():
            own = np.sort(values[[k for k in range(len(values)) if all(k % {"iter": 3, "face": 5}[b] == r[b] for b in by)]])
            below, upto = np.searchsorted(own, r.v) / len(own), np.searchsorted(own, r.v, "right") / len(own)
            assert max(below - r.share, r.share - upto, 0) <= 3 / size, (by, r)
    limits = summaries.quantiles(summaries.merge(stored, [], size), shares)
    assert all(r.error <= 3 / size for r in summaries.rank_errors(df, "v", limits).collect())
    stored.unpersist()


def test_a_batch_killed_before_its_entry_counts_once(spark, tmp_path):
    from oceanloom.streaming.commit_log import CommitLog, write_stream

    df = spark.range(600).withColumn("v", F.col("id") * 2)
    df.repartition(6).write.parquet(f"{tmp_path}/src")
    source = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/src")
    log = CommitLog(spark, f"{tmp_path}/sink")

    def killed(number):
        if number == 1:
            raise RuntimeError("killed between write and entry")

    with pytest.raises(Exception, match="killed"):
        write_stream(source(), f"{tmp_path}/sink", f"{tmp_path}/ck", before_commit=killed).awaitTermination()
    assert log.read().count() < 600 and len(log.counting()) == 1
    write_stream(source(), f"{tmp_path}/sink", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.id for r in log.read().collect()) == list(range(600)) and len(log.counting()) == 3
    held = log.read()  # a reader that began before the compaction
    assert log.compact() and len(log.counting()) == 1 and not log.compact()
    assert held.count() == log.read().count() == 600
    assert log.vacuum() == 4 and log.read().count() == 600
    name = log.counting()[0]["name"]
    assert not log.append(df, name) and not log.commit(name, "data/other") and log.read().count() == 600
    assert log.append(df.select("id").limit(5), "later") and log.read().where("v IS NULL").count() == 5
    assert CommitLog(spark, f"{tmp_path}/none").read(df.schema).count() == 0


def test_conflicting_values_end_the_merge(spark):
    from oceanloom.operators import model

    state = spark.createDataFrame([(0, 0, 0, 1.0, 5.0), (0, 0, 1, None, 6.0), (1, 0, 0, 2.0, 7.0)], "face INT, j INT, i INT, salt DOUBLE, theta DOUBLE")
    grid = spark.createDataFrame([(0, 0, 0, 1.0, 9.0), (0, 0, 1, 4.0, 9.0), (2, 0, 0, 3.0, 9.0)], "face INT, j INT, i INT, salt DOUBLE, depth DOUBLE")
    want = {(0, 0, 0, 1.0), (0, 0, 1, 4.0), (1, 0, 0, 2.0), (2, 0, 0, 3.0)}
    for compat in ("override", "no_conflicts"):
        assert {(r.face, r.j, r.i, r.salt) for r in model.merge(state, grid, compat=compat).collect()} == want
    other = grid.withColumn("salt", F.when(F.col("i") == 1, F.col("salt")).otherwise(F.col("salt") + 1))
    assert {(r.face, r.j, r.i, r.salt) for r in model.merge(state, other).where("face < 2").collect()} == {(0, 0, 0, 1.0), (0, 0, 1, 4.0), (1, 0, 0, 2.0)}
    with pytest.raises(Exception, match="conflicting values of salt at face, j, i 0 0 0"):
        model.merge(state, other, compat="no_conflicts").collect()
    with pytest.raises(ValueError):
        model.merge(state, grid, compat="equals")


def test_sizes_come_from_file_footers(spark, tmp_path):
    from oceanloom.operators import stats

    spark.range(500).select(F.col("id").cast("int").alias("face"), F.lit(1.5).alias("v")).write.parquet(f"{tmp_path}/p")
    sized = stats.size_bytes(spark.read.parquet(f"{tmp_path}/p"))
    assert tuple(sized.first()) == (500, 500 * 12) and "ReadSchema: struct<>" in sized._jdf.queryExecution().executedPlan().toString()


def test_faces_with_negative_salinity(spark):
    from oceanloom.functions import eos

    df = spark.createDataFrame([(0, -1.0), (0, 3.0), (1, 0.0), (1, None), (2, None)], "face INT, salt DOUBLE")
    assert {tuple(r) for r in eos.any_negative_salinity(df).collect()} == {(0, True), (1, False), (2, False)}


def test_image_dataset_end_to_end(spark):
    """Samples lie beyond the halo, records say why a sample has no image, images equal pooling of their own patches."""
    from oceanloom.plans.dataset import Recipe, front_strength, image_dataset

    n = 40
    cells = spark.range(n * n).select(
        F.lit(0).alias("face"), F.floor(F.col("id") / n).cast("int").alias("j"), (F.col("id") % n).cast("int").alias("i"), (F.col("id") * F.col("id") % 197 / 19.0).alias("theta"), (F.lit(34.0) + F.col("id") % 31 / 50.0).alias("salt"),
        F.when(F.col("id") % n < 3, 0.0).otherwise(1.0).alias("hfacc"), F.lit(1000.0).alias("dxc"), F.lit(1000.0).alias("dyc"), F.lit(1.0).alias("cs"), F.lit(0.0).alias("sn"),
    )
    recipe = Recipe(halo_km=4.0, patch_km=9.0, samples=30, bias=0.3, target=8, channels=("theta", "salt"), seed=5, block=16)
    records, images = image_dataset(cells, recipe)
    rows = records.collect()
    assert sorted(r.sample_id for r in rows) == list(range(1, 31)) and min(r.i for r in rows) >= 3 + 4
    strength = {(r.j, r.i): r.v for r in front_strength(cells).collect()}
    assert all(abs(r.v - strength[r.j, r.i]) < 1e-12 for r in rows)
    fine = {r.sample_id for r in rows if r.status == "ok"}
    assert fine and {r.status for r in rows} <= {"ok", "i_low", "i_high", "j_low", "j_high"} and {r.sample_id for r in images.select("sample_id").distinct().collect()} == fine
    again = patches.downsample(patches.patch_pixels(cells, records, ["theta", "salt"], with_size=True), 8)
    assert sorted((r.sample_id, r.channel, r.y, r.x, round(r.v, 4)) for r in images.collect()) == sorted((r.sample_id, r.channel, r.y, r.x, round(r.v, 4)) for r in again.collect())
    small, none = image_dataset(cells, Recipe(halo_km=4.0, patch_km=9.0, samples=30, bias=0.3, target=64, seed=5, block=16))
    assert none.count() == 0 and {r.status for r in small.collect()} <= {"small", "i_low", "i_high", "j_low", "j_high"}
