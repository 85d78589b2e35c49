"""What grows with the grid: joins of cells, pairs of equal values, calls for blocks."""

from pyspark.sql import functions as F

from oceanloom.operators import distance, sampling
from oceanloom.plans import dataset
from oceanloom.sources import blocks


def test_mask_of_cells_is_never_broadcast(spark):
    cells = spark.range(500).select(F.lit(0).alias("face"), F.col("id").cast("int").alias("j"), F.lit(0).alias("i"))
    joined = dataset.with_mask(cells.withColumn("v", F.lit(1.0)), cells.withColumn("retained", F.lit(True)).checkpoint())
    assert joined.count() == 500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_equal_values_and_samples_make_one_pair(spark):
    df = spark.range(3000).select("id", F.lit(5.0).alias("v"))
    got = sampling.first_match(df, df.select(F.col("id").alias("sample_id"), F.col("v").alias("s")), "v", "id", 0.01)
    assert got.where("match = 0").count() == 3000 == got.count()
    under = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert under.count("Aggregate") == 2  # both sides of the join by buckets are made distinct first


def test_blocks_of_large_grids_are_larger(spark, monkeypatch):
    mask = spark.range(100 * 50).select(F.lit(0).alias("face"), (F.col("id") / 50).cast("int").alias("j"), (F.col("id") % 50).cast("int").alias("i"), (F.col("id") % 997 == 30).alias("masked"))
    spacing = spark.createDataFrame([(0, 1.0, 1.0)], "face INT, dx_km DOUBLE, dy_km DOUBLE")
    assert [blocks.side_for(mask, 16, most) for most in (28, 27, 8, 7, 1)] == [16, 32, 32, 64, 128]
    want = sorted(map(tuple, distance.distances(mask, spacing, 5.0, 16).collect()))
    made, packed = [], distance._packed
    monkeypatch.setattr(blocks, "MOST_BLOCKS", 8)
    monkeypatch.setattr(distance, "_packed", lambda mask, spacing, block: made.append(block) or packed(mask, spacing, block))
    got = sorted(map(tuple, distance.distances(mask, spacing, 5.0, 16).collect()))
    assert made == [32] and [r[:4] for r in got] == [r[:4] for r in want]
    assert all((a[4] is None) == (b[4] is None) and (a[4] is None or abs(a[4] - b[4]) < 1e-9) for a, b in zip(got, want, strict=True))
