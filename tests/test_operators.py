"""Hand-computed cases and properties."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oceanloom import schema
from oceanloom.functions import eos
from oceanloom.operators import halo, model, patches, sampling, stats, stencil
from oceanloom.schema import PATCH_SCHEMA
from oceanloom.sources import metadata, readers
from oceanloom.streaming import metadata_stream


def grid(spark, nj, ni, dx=1000.0, dy=1000.0, face=0):
    rows = [(face, j, i, dx, dy, 1.0, 0.0) for j in range(nj) for i in range(ni)]
    return spark.createDataFrame(rows, "face INT, j INT, i INT, dxc DOUBLE, dyc DOUBLE, cs DOUBLE, sn DOUBLE")


def test_density_golden_value_and_sql_function(spark):
    eos.register(spark)
    row = spark.range(1).select(eos.density(F.lit(35.5), F.lit(3.0), 3000.0).alias("d"), F.expr("seawater_density(35.5D, 3.0D, 3000.0D)").alias("s")).first()
    assert row.d == pytest.approx(1041.83267, abs=1e-5)
    assert row.s == pytest.approx(row.d, abs=1e-9)


def test_negative_salinity_is_null_and_counted(spark):
    df = spark.createDataFrame([(-1.0, 3.0), (35.0, 3.0), (None, 3.0)], "salt DOUBLE, theta DOUBLE")
    assert [r.d is None for r in df.select(eos.density("salt", "theta").alias("d")).collect()] == [True, False, True]
    assert eos.negative_salinity(df).first()[0] == 1


def test_nan_becomes_null_and_land(spark):
    df = schema.nan_to_null(spark.createDataFrame([(0, 0, 0, float("nan")), (0, 0, 1, 1.0), (0, 0, 2, 0.0)], "face INT, j INT, i INT, hfacc DOUBLE"))
    got = {r.i: (r.maskc, r.is_ocean) for r in model.with_land_mask(df).collect()}
    assert got == {0: (None, False), 1: (1.0, True), 2: (None, False)}


def test_merge_keeps_cells_of_either_side(spark):
    state = spark.createDataFrame([(0, 0, 0, 1.0)], "face INT, j INT, i INT, theta DOUBLE")
    geometry = spark.createDataFrame([(0, 0, 0, 1.0), (1, 0, 0, 0.0)], "face INT, j INT, i INT, hfacc DOUBLE")
    merged, land = model.prepare(state, geometry)
    assert sorted((r.face, r.theta, r.maskc) for r in merged.collect()) == [(0, 1.0, 1.0), (1, None, None)]
    assert land.count() == 2 and model.conflicts(state, geometry).count() == 0


def test_gradient_of_a_plane_and_rotation(spark):
    g = grid(spark, 5, 6).withColumn("s", F.col("i") * 2000.0 + F.col("j") * 3000.0)
    inner = (F.col("i").between(1, 4)) & (F.col("j").between(1, 3))
    plain = stencil.tracer_gradient(g, "s").where(inner).select("zonal", "merid").distinct().collect()
    assert [tuple(r) for r in plain] == [(2.0, 3.0)]
    turned = stencil.tracer_gradient(g.withColumn("cs", F.lit(0.0)).withColumn("sn", F.lit(1.0)), "s").where(inner).select("zonal", "merid").distinct().collect()
    assert [tuple(r) for r in turned] == [(-3.0, 2.0)]


@pytest.mark.parametrize("boundary, first", [("null", None), ("fill", 5.0), ("extend", 0.0), ("periodic", 5.0 - 9.0)])
def test_difference_boundaries(spark, boundary, first):
    df = spark.createDataFrame([(0, 0, 0, 5.0), (0, 0, 1, 7.0), (0, 0, 2, 9.0)], "face INT, j INT, i INT, v DOUBLE")
    got = {r.i: r.d for r in df.select("i", stencil.left_difference("v", "i", boundary).alias("d")).collect()}
    assert got == {0: first, 1: 2.0, 2: 2.0}


def test_stencil_does_not_reach_over_a_gap(spark):
    df = spark.createDataFrame([(0, 0, 0, 5.0), (0, 0, 2, 9.0)], "face INT, j INT, i INT, v DOUBLE")
    assert {r.d for r in df.select(stencil.left_difference("v", "i").alias("d")).collect()} == {None}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 5 + [(None,)], "v DOUBLE")
    rows = stats.probability_table(df, "v", 2).orderBy("bin").collect()
    assert [(r.lo, r.hi, r.n) for r in rows] == [(1.5, 2.0, 0), (2.0, 2.5, 5)]
    assert rows[-1].cdf == 1.0


def test_histogram_equals_numpy(spark):
    v = np.random.default_rng(3).normal(size=2000)
    df = spark.createDataFrame([(float(x),) for x in v], "v DOUBLE")
    rows = stats.probability_table(df, "v", 50).orderBy("bin").collect()
    lo, hi = np.percentile(v, [0.1, 99.9])
    want, _ = np.histogram(np.clip(v, lo, hi), 50, (lo, hi))
    assert [r.n for r in rows] == want.tolist() and sum(r.n for r in rows) == 2000


def test_sample_has_no_duplicates_and_ignores_partitioning(spark):
    df = spark.range(500).select(F.lit(0).alias("face"), (F.col("id") % 20).cast("int").alias("j"), F.floor(F.col("id") / 20).cast("int").alias("i"), (F.col("id") / 100.0).alias("v"))
    keep = F.col("j") != 3
    a, b = (sampling.weighted_sample(df.repartition(k), 40, 0.7, keep=keep, seed=5).collect() for k in (1, 7))
    assert a == b and len({(r.j, r.i) for r in a}) == 40 and all(r.j != 3 for r in a)
    with pytest.raises(ValueError):
        sampling.weighted_sample(df.limit(3), 4, 0.0)


def test_inclusion_frequencies_match_successive_sampling(spark):
    w = [1.0, 2.0, 5.0, 12.0]
    base = spark.createDataFrame([(0, 0, k, math.log(x)) for k, x in enumerate(w)], "face INT, j INT, i INT, v DOUBLE")
    from oceanloom.functions.hashing import gumbel, uniform

    key = F.col("v") + gumbel(uniform("i", "t"))
    trials = base.crossJoin(spark.range(4000).withColumnRenamed("id", "t")).withColumn("key", key)
    top = trials.groupBy("t").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("key", "i")))), 1, 2).alias("x")).select(F.explode("x.i").alias("i"))
    got = {r.i: r["count"] / 4000 for r in top.groupBy("i").count().collect()}
    rng, exact = random.Random(1), Counter()
    for _ in range(20000):
        left = dict(enumerate(w))
        for _ in range(2):
            k = rng.choices(list(left), list(left.values()))[0]
            exact[k] += 1 / 20000
            del left[k]
    assert all(abs(got[k] - exact[k]) < 0.03 for k in range(4))


def test_linear_bin_counts(spark):
    assert [r.n for r in sampling.linear_bin_counts(spark, 1000, 10, 0, 100.0).orderBy("bin").collect()] == [1, 23, 45, 67, 89, 110, 132, 154, 176, 198]


def test_extent_on_even_spacing(spark):
    g = grid(spark, 20, 20)
    s = spark.createDataFrame([(1, 0, 10, 10)], "sample_id BIGINT, face INT, j INT, i INT")
    assert tuple(patches.extent(s, g, "i", 3.5).first()) == (1, 3, 3, 6.0)
    bounds = patches.patch_bounds(s, g, 7.0).first()
    assert (bounds.i_start, bounds.i_end, bounds.j_start, bounds.j_end, bounds.status) == (7, 13, 7, 13, "ok")


def _loop_extent(d, c, km):
    low, high = np.cumsum(d[: c + 1][::-1]), np.cumsum(d[c:])
    left, right = int((low < km).sum()), int((high < km).sum())
    if left == len(low):
        left = right
    elif right == len(high):
        right = left
    return left, right


def test_extent_equals_a_loop_on_uneven_spacing(spark):
    rng = np.random.default_rng(2)
    dx = rng.uniform(500, 1500, 20)
    g = spark.createDataFrame([(0, 0, i, float(dx[i]), 1000.0) for i in range(20)], "face INT, j INT, i INT, dxc DOUBLE, dyc DOUBLE")
    s = spark.createDataFrame([(i, 0, 0, i) for i in range(20)], "sample_id BIGINT, face INT, j INT, i INT")
    d = 0.5 * (dx[:-1] + dx[1:]) / 1000
    got = {r.sample_id: (r.low, r.high) for r in patches.extent(s, g, "i", 4.0).collect()}
    assert got == {c: _loop_extent(d, c, 4.0) for c in range(20)}


def test_rejects_at_each_edge(spark):
    g = grid(spark, 12, 12).withColumn("dxc", F.when(F.col("i") < 6, 400.0).otherwise(1000.0))
    s = spark.createDataFrame([(1, 0, 6, 1), (2, 0, 6, 11), (3, 0, 1, 6), (4, 0, 11, 6)], "sample_id BIGINT, face INT, j INT, i INT")
    assert {r.sample_id: r.status for r in patches.patch_bounds(s, g, 7.0).collect()} == {1: "i_low", 2: "i_high", 3: "j_low", 4: "j_high"}


def test_downsample_windows_and_missing(spark):
    px = spark.createDataFrame([(1, 0, y, x, float(y)) for y in range(5) for x in range(5)], "sample_id BIGINT, channel INT, y INT, x INT, v FLOAT")
    got = {(r.y, r.x): r.v for r in patches.downsample(px, 2).collect()}
    assert got == {(0, 0): 1.0, (0, 1): 1.0, (1, 0): 3.0, (1, 1): 3.0}
    assert sorted(map(tuple, patches.downsample(px, 5).collect())) == sorted(map(tuple, px.collect()))
    holed = px.withColumn("v", F.when((F.col("y") == 0) & (F.col("x") == 0), None).otherwise(F.col("v")))
    assert {(r.y, r.x): r.v for r in patches.downsample(holed, 2).collect()}[(0, 0)] is None
    with pytest.raises(ValueError):
        patches.downsample(px, 6, strict=True)


def test_tensor_round_trip(spark):
    px = spark.createDataFrame([(1, c, y, x, float(c * 100 + y * 10 + x)) for c in range(2) for y in range(3) for x in range(4)], "sample_id BIGINT, channel INT, y INT, x INT, v FLOAT")
    t = patches.tensors(px)
    assert (t.first().c, t.first().h, t.first().w, len(t.first().data)) == (2, 3, 4, 24)
    assert sorted(map(tuple, patches.tensor_pixels(t).collect())) == sorted(map(tuple, px.collect()))


@pytest.mark.parametrize("method", [halo.euclid, halo.marched])
def test_halo_of_a_straight_coast_and_whole_faces(spark, method):
    faces = grid(spark, 6, 10).unionByName(grid(spark, 6, 10, face=1)).unionByName(grid(spark, 6, 10, face=2))
    mask = faces.select("face", "j", "i", F.when(F.col("face") == 0, F.col("i") < 3).otherwise(F.col("face") == 1).alias("masked"))
    got = method(mask, faces, 2.2).where("retained").groupBy("face").agg(F.min("i").alias("i"), F.count("*").alias("n")).collect()
    # Distances 0.5, 1.5, 2.5 ... from column 3 on: column 5 is the first at 2.2 km or more.
    assert {r.face: (r.i, r.n) for r in got} == {0: (5, 30), 2: (0, 60)}


def test_first_match_and_misses(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 5.0), (3, None)], "k BIGINT, v DOUBLE")
    s = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 3.0)], "sample_id BIGINT, s DOUBLE")
    assert sorted(map(tuple, sampling.first_match(df, s, "v", "k", 1e-10).collect()), key=str) == [(1, 1.0, 0), (2, 1.0, 0), (3, 3.0, None)]


def test_snapshot_round_trip_prunes_partitions(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 2 * 144 + 10000).alias("iter"), (F.col("id") % 5).cast("int").alias("face"), (F.col("id") % 40).cast("int").alias("j"), F.floor(F.col("id") / 40).cast("int").alias("i"), F.col("id").cast("double").alias("theta"), F.lit(0).alias("k"))
    readers.write_partitioned(df, str(tmp_path / "s"), 16)
    got = readers.read_snapshot(spark, str(tmp_path / "s"), 10144, [1, 3])
    assert got.count() == 400 and {r.face for r in got.select("face").distinct().collect()} == {1, 3}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "iter" in plan.split("PartitionFilters")[1].split("]")[0]
    twice = readers.read_snapshots(spark, [str(tmp_path / "s")] * 2, 10144)
    assert twice.count() == 1000


def test_listing_and_references(spark, tmp_path):
    for n in ("snap_f1_k0_iter_7.json", "snap_f2_k0_iter_9.json", "other.json"):
        (tmp_path / n).write_text('{"version": 1}')
    files = readers.list_objects(spark, str(tmp_path))
    assert readers.latest(files, "snap_f").first().iter == 9
    assert readers.read_references(spark, str(tmp_path)).count() == 3


def test_metadata_sink_appends_and_merges_columns(spark, tmp_path):
    path = str(tmp_path / "m")
    with metadata.MetadataWriter(spark, path, 2) as w:
        for k in range(5):
            w.add({"sample_id": k} | ({"note": "x"} if k == 4 else {}))
    back = metadata.read(spark, path)
    assert back.count() == 5 and back.where("note IS NOT NULL").count() == 1


def test_metadata_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    df.write.parquet(src)
    q = metadata_stream.write_stream(spark.readStream.schema(df.schema).parquet(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert metadata.read(spark, str(tmp_path / "out")).count() == 100


def test_stores_with_depth_levels_read_as_one(spark, tmp_path):
    rows = [(10, 0, f, 0, i, k, float(100 * f + 10 * i + k)) for f in (1, 2) for i in range(3) for k in (2, 0, 1)]
    deep = spark.createDataFrame(rows, "iter BIGINT, time_idx INT, face INT, j INT, i INT, k INT, theta DOUBLE")
    readers.write_partitioned(deep.where("face = 1"), f"{tmp_path}/a")
    readers.write_partitioned(deep.withColumn("theta", F.col("theta") + 0.5).withColumn("salt", F.lit(35.0)), f"{tmp_path}/b")
    got = {(r.face, r.i): (r.theta, r.salt) for r in readers.read_snapshots(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], 10).collect()}
    assert got == {(f, i): (100.0 * f + 10 * i + (0.5 if f == 2 else 0), 35.0 if f == 2 else None) for f in (1, 2) for i in range(3)}
    alone = readers.read_snapshot(spark, f"{tmp_path}/a", 10)
    assert alone.count() == 3 and alone.columns == ["iter", "face", "j", "i", "theta"]


def test_public_stores_need_no_credentials():
    options = readers.public_store_options("https://store.example", "nowhere-1")
    assert options["spark.hadoop.fs.s3a.aws.credentials.provider"].endswith("AnonymousAWSCredentialsProvider")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "https://store.example" and options["spark.hadoop.fs.s3a.endpoint.region"] == "nowhere-1"
    assert len(readers.public_store_options()) == 1


def test_metadata_records_of_drifting_types(spark, tmp_path):
    path = f"{tmp_path}/records"
    with metadata.MetadataWriter(spark, path, flush_every=2) as w:
        for r in ({"a": 1, "gone": None}, {"a": 2, "gone": None}, {"a": 2.5, "b": "x", "c": True}, {"b": 7}, {"gone": None}):
            w.add(r)
    rows = metadata.read(spark, path).collect()
    assert sorted(((r.a, r.b, r.c) for r in rows), key=str) == sorted([(1.0, None, None), (2.0, None, None), (2.5, "x", True), (None, "7", None), (None, None, None)], key=str)
    typed = f"{tmp_path}/typed"
    with metadata.MetadataWriter(spark, typed, schema=PATCH_SCHEMA) as w:
        w.add({"sample_id": 1, "face": 2, "status": "ok"})
        w.add({"sample_id": 2, "face": 3, "real_km_w": 1.5, "status": "i_low"})
    assert metadata.read(spark, typed).schema.fieldNames() == PATCH_SCHEMA.fieldNames()
    assert [(r.sample_id, r.real_km_w) for r in metadata.read(spark, typed).orderBy("sample_id").collect()] == [(1, None), (2, 1.5)]
    with pytest.raises(ValueError, match="schema lacks"):
        w = metadata.MetadataWriter(spark, typed, schema=PATCH_SCHEMA)
        w.add({"unknown": 1})
        w.flush()


@pytest.mark.parametrize("tolerance", [1e-10, 0.3, 7.0])
def test_first_match_equals_a_loop_at_any_scale(spark, tolerance):
    rng = random.Random(4)
    base = [0.0, -0.0, 1e10, -1e10, 1e10 + 2e-6, 5.0, 1e300, 123.456]
    values = [(k, rng.choice(base) + rng.choice([0.0, tolerance * 0.5, -tolerance * 0.99, tolerance * 1.01, rng.uniform(-20, 20)])) for k in range(300)] + [(300, None)]
    asked = [(k, b + rng.choice([0.0, tolerance / 3])) for k, b in enumerate(base)]
    df = spark.createDataFrame(values, "o INT, v DOUBLE")
    got = {r.sample_id: r.match for r in sampling.first_match(df, spark.createDataFrame(asked, "sample_id INT, s DOUBLE"), "v", "o", tolerance).collect()}
    assert got == {k: min((o for o, v in values if v is not None and abs(v - s) < tolerance), default=None) for k, s in asked}


@pytest.mark.parametrize("fetched", [20_000, 3])
def test_quantiles_equal_sorting(spark, monkeypatch, fetched):
    monkeypatch.setattr(stats, "FETCHED", fetched)
    monkeypatch.setattr(stats, "NARROWING", 16)
    rng = np.random.default_rng(8)
    for values in (rng.normal(size=700), np.round(rng.normal(size=500), 1), np.full(40, 2.5), np.concatenate([np.zeros(300), rng.exponential(size=20) ** 9]), [1.0], [3.0, 1.0]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v DOUBLE")
        shares = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
        assert np.allclose(stats.values_at(df, "v", shares), np.quantile(values, shares), rtol=1e-12, atol=1e-12)
    assert stats.quantiles(df.where("false"), "v", 0.1, 0.9).collect() == [(None, None)]
