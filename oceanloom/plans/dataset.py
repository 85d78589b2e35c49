"""From fields to an image dataset: halo, field, biased sample, patches, images and their records, as one job after another.

Each step is the library's own operator; what several steps read is written once to the shared folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.functions import eos
from oceanloom.operators import halo, patches, sampling, stencil
from oceanloom.operators.stats import log_magnitude
from oceanloom.sources.scratch import remove, shared_folder


@dataclass(frozen=True)
class Recipe:
    """How a dataset is made: kilometres of halo and patch, samples and their bias to strong fronts, pixels, channels, cells of a block."""

    halo_km: float = 10.0
    patch_km: float = 64.0
    samples: int = 10_000
    bias: float = 1.0
    target: int = 64
    channels: tuple[str, ...] = ("theta", "salt")
    seed: int = 0
    block: int = 720


def front_strength(cells: DataFrame) -> DataFrame:
    """``face, j, i, v``: the log of the squared gradient of buoyancy (per 1e-4), NULL where it is 0 or missing."""
    gradient = stencil.tracer_gradient(cells.withColumn("_b", eos.buoyancy() * 1e4), "_b")
    return gradient.select("face", "j", "i", log_magnitude(stencil.grad_squared()).alias("v"))


def with_mask(field: DataFrame, kept: DataFrame) -> DataFrame:
    """The field beside its mask.  Both have a row for each cell, but the mask is estimated by the packed blocks that it comes from, and would be broadcast."""
    return field.join(kept.hint("merge"), ["face", "j", "i"])


def image_dataset(cells: DataFrame, recipe: Recipe = Recipe()) -> tuple[DataFrame, DataFrame]:
    """``(records, images)`` from cells with ``theta, salt, hfacc, dxc, dyc, cs, sn`` and the channels.

    Records: ``sample_id, face, j, i, v``, the patch's bounds and kilometres, and ``status``, which says why a sample has no image: the edge that its
    patch crosses, or ``small`` where it has fewer cells than pixels.  Images: ``sample_id, channel, y, x, v``.
    Cells within the halo, and those without a field, are never drawn; fewer cells than samples give as many records.
    """
    spark = cells.sparkSession
    folder = f"{shared_folder(spark)}/dataset-{uuid.uuid4().hex}"
    used = {"face", "j", "i", "theta", "salt", "hfacc", "dxc", "dyc", "cs", "sn", "jb", "ib", *recipe.channels}
    try:
        # Eight steps read the cells; what they come from is joined once, and its broadcasts don't add up in the driver.
        cells.select(*[c for c in cells.columns if c in used]).write.parquet(f"{folder}/cells")
        cells = spark.read.schema(cells.select(*[c for c in cells.columns if c in used]).schema).parquet(f"{folder}/cells")
        masked = cells.select("face", "j", "i", (~F.coalesce(F.col("hfacc") > 0, F.lit(False))).alias("masked"))
        kept = halo.marched(masked, cells, recipe.halo_km, recipe.block)
        field = with_mask(front_strength(cells), kept)
        field.write.parquet(f"{folder}/field")
        field = spark.read.parquet(f"{folder}/field")
        chosen = sampling.weighted_sample(field, recipe.samples, recipe.bias, keep=F.col("retained"), seed=recipe.seed, strict=False)
        chosen.select(F.col("sample_rank").cast("bigint").alias("sample_id"), "face", "j", "i").write.parquet(f"{folder}/samples")
        samples = spark.read.parquet(f"{folder}/samples")
        patches.patch_bounds(samples, cells, recipe.patch_km).write.parquet(f"{folder}/bounds")
        bounds = spark.read.parquet(f"{folder}/bounds")
        high, wide = (F.col(f"{c}_end") - F.col(f"{c}_start") + 1 >= recipe.target for c in ("j", "i"))
        status = F.when((F.col("status") == "ok") & ~(high & wide), "small").otherwise(F.col("status"))
        whole = samples.join(bounds.withColumn("status", status).drop("face"), "sample_id")
        values = field.join(F.broadcast(samples) if recipe.samples <= patches.MOST_BROADCAST else samples, ["face", "j", "i"]).select("sample_id", "v")
        records = whole.join(values, "sample_id").checkpoint()
        images = patches.pooled(cells, bounds, list(recipe.channels), recipe.target, block=recipe.block).checkpoint()
        return records, images
    finally:
        remove(spark, folder)
