"""Grid frames built from the star-schema test tables: one cell per order, 13 faces of 32 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.schema import nan_to_null

FACES, COLUMNS = 13, 32
PER_ROW = FACES * COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``face, j, i, theta, salt, hfacc, dxc, dyc, cs, sn``; NaN is NULL."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    rows = orders.agg(F.floor(F.count("*") / PER_ROW).cast("int").alias("nj"))
    k = F.col("o_orderkey")
    keyed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            (k % FACES).cast("int").alias("face"),
            F.floor(F.floor(k / FACES) / COLUMNS).cast("int").alias("j"),
            (F.floor(k / FACES).cast("bigint") % COLUMNS).cast("int").alias("i"),
            F.col("o_totalprice").alias("tp"),
            F.col("c_acctbal").alias("ab"),
        )
        .join(F.broadcast(rows), F.col("j") < F.col("nj"))  # one row
    )
    face, j, i, q = F.col("face"), F.col("j"), F.col("i"), F.col("face") / F.lit(13.0)
    land = (face != 6) & (j % 12 < 3) & i.between(8, 13)
    out = keyed.select(
        "face", "j", "i",
        (F.lit(-1.8) + F.lit(32.0) * (F.col("tp") - 1000.0) / 500000.0).alias("theta"),
        (F.lit(30.0) + F.lit(8.0) * (F.col("ab") + 1000.0) / 11000.0).alias("salt"),
        F.when((face == 7) & (i == 31) & (j % 5 == 0), F.lit(float("nan"))).when(face == 5, 0.0).when(land, 0.0).otherwise(1.0).alias("hfacc"),
        (F.lit(900.0) + F.lit(10.0) * (i % 7) + F.lit(5.0) * (j % 3)).alias("dxc"),
        (F.lit(950.0) + F.lit(10.0) * (j % 5) + F.lit(4.0) * (i % 4)).alias("dyc"),
        ((F.lit(1.0) - q * q) / (F.lit(1.0) + q * q)).alias("cs"),
        (F.lit(2.0) * q / (F.lit(1.0) + q * q)).alias("sn"),
    )
    return nan_to_null(out)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select(F.lit(10000).cast("bigint").alias("iter"), "face", "j", "i", "theta", "salt")


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select("face", "j", "i", "dxc", "dyc", "hfacc", "cs", "sn")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos, path``: object names, with names that the parser must refuse."""
    k = F.col("o_orderkey")
    good = F.format_string("bucket/surface/snap_f%d_k0_iter_%d.json", k % 13, F.lit(10000) + F.lit(144) * (k % 97))
    name = (
        F.when(k % 11 == 3, F.concat(F.lit("bucket/surface/other_"), F.element_at(F.split(good, "/"), -1)))
        .when(k % 11 == 5, F.concat(good, F.lit(".tmp")))
        .when(k % 11 == 7, F.lit("bucket/surface/snap_f1_k0_iter_x99.json"))
        .otherwise(good)
    )
    return table(spark, sf_dir, "orders").select(k.alias("pos"), name.alias("path"))
