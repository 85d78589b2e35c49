"""The registered queries: each applies one operator to whole tables.  Doubles are rounded to six places for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.functions import eos
from oceanloom.functions.hashing import uniform
from oceanloom.operators import halo, model, mosaic, patches, sampling, seams, stats, stencil, summaries
from oceanloom.plans.dataset import Recipe, image_dataset
from oceanloom.sources import blocks, chunks, metadata, readers, scratch, tables
from oceanloom.streaming import commit_log

PATCH_KM, IMAGE, HALO_KM, BIAS, SAMPLES, SEED = 7.0, 4, 2.2, 0.5, 50, 7
PREFIX = "snap_f"
#: Cells along a side of a block, small enough for the test grid to have many.
TILE = 24
SUMMARY = 64
#: Seams of the test grid in every kind of turn: along an axis, from one axis to the other, against each other, a face with itself.
SEAMS = [
    (0, "i_high", 1, "i_low", False), (1, "j_high", 2, "j_low", False), (2, "i_high", 3, "j_low", True), (3, "j_high", 4, "i_high", False),
    (7, "i_high", 8, "i_high", True), (8, "j_low", 9, "j_low", True), (10, "j_low", 11, "i_low", True), (11, "j_high", 12, "i_low", False), (6, "i_low", 6, "i_high", False),
]


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in names})


def _masked(spark: SparkSession, d: str) -> DataFrame:
    return tables.geometry(spark, d).select("face", "j", "i", (~F.coalesce(F.col("hfacc") > 0, F.lit(False))).alias("masked"))


def _field(spark: SparkSession, d: str) -> DataFrame:
    """Buoyancy per 1e-4 with its rotated gradient: the field that the statistics and samples use."""
    return stencil.tracer_gradient(tables.cells(spark, d).withColumn("b", eos.buoyancy() * 1e4), "b").withColumn("g2", stencil.grad_squared())


def _samples(spark: SparkSession, d: str) -> DataFrame:
    cells = tables.cells(spark, d).select("face", "j", "i", F.col("theta").alias("v"), "hfacc")
    chosen = sampling.weighted_sample(cells, SAMPLES, BIAS, keep=F.col("hfacc") > 0, seed=SEED, strict=False)
    return chosen.select(F.col("sample_rank").cast("bigint").alias("sample_id"), "face", "j", "i")


def _bounds(spark: SparkSession, d: str) -> DataFrame:
    """The samples are drawn once: the bounds read them three times."""
    return patches.patch_bounds(_kept(_samples(spark, d)), tables.geometry(spark, d), PATCH_KM)


def _pixels(spark: SparkSession, d: str, with_size: bool = False) -> DataFrame:
    return patches.patch_pixels(tables.cells(spark, d), _bounds(spark, d), ["theta", "salt"], with_size)


@contextmanager
def _written(spark: SparkSession) -> Iterator[str]:
    """A folder for what a query writes and reads back; it is removed when the rows have been taken by ``_kept``."""
    folder = f"{scratch.shared_folder(spark)}/query-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        scratch.remove(spark, folder)


def _kept(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the shared folder, so that their source may go."""
    scratch.shared_folder(df.sparkSession)
    return df.checkpoint()


def scan_snapshot(spark, d):
    return _round(readers.select_snapshot(tables.snapshot(spark, d), 10000, [0, 5, 7]), "theta", "salt")


def scan_grid(spark, d):
    return _round(tables.geometry(spark, d), "cs", "sn")


def list_theta_files(spark, d):
    return readers.parse_listing(tables.listing(spark, d), PREFIX).select("pos", "path", "iter")


def latest_iteration(spark, d):
    return readers.latest(tables.listing(spark, d), PREFIX)


def last_listed_file(spark, d):
    return readers.last_listed(tables.listing(spark, d), PREFIX)


def _partial_state(spark: SparkSession, d: str) -> DataFrame:
    """State of all faces but for every seventh diagonal of cells."""
    return readers.select_snapshot(tables.snapshot(spark, d), 10000).where((F.col("i") + F.col("j")) % 7 != 0).drop("iter")


def merge_landmask(spark, d):
    merged, _ = model.prepare(_partial_state(spark, d), tables.geometry(spark, d))
    return _round(merged.select("face", "j", "i", "theta", "salt", "maskc", "is_ocean"), "theta", "salt")


def merge_inner(spark, d):
    merged, _ = model.prepare(_partial_state(spark, d), tables.geometry(spark, d), "inner")
    return _round(merged.select("face", "j", "i", "theta", "salt", "maskc", "is_ocean"), "theta", "salt")


def flux_variables(spark, d):
    o = tables.cells(spark, d)
    flux = o.select(F.lit(10000).cast("bigint").alias("iter"), F.lit(0).alias("time_idx"), "face", "j", "i", (F.col("theta") * 2).alias("KPPhbl"), (F.col("salt") / 2).alias("oceTAUX"), "theta")
    return _round(readers.select_snapshot(flux, 10000, variables="flux"), "KPPhbl", "oceTAUX")


def read_stores(spark, d):
    """Two stores with a depth dimension, written by iteration and face, read as one; the first wins where both hold a cell."""
    cells = tables.snapshot(spark, d).select("iter", "face", "j", "i", "theta").withColumn("k", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    deeper = cells.withColumn("theta", F.col("theta") - F.col("k"))
    with _written(spark) as folder:
        readers.write_partitioned(deeper.where("face <= 7"), f"{folder}/a")
        readers.write_partitioned(deeper.where("face >= 5").withColumn("theta", F.col("theta") + 100), f"{folder}/b")
        return _kept(_round(readers.read_snapshots(spark, [f"{folder}/a", f"{folder}/b"], 10000, [0, 5, 7, 8, 12]), "theta"))


def read_chunks(spark, d):
    """The snapshot, written as chunk objects and reference files, and read by iteration, faces and a range of rows and columns."""
    cells = tables.cells(spark, d).select(F.lit(10000).cast("bigint").alias("iter"), "face", "j", "i", F.col("theta").alias("Theta"), F.col("hfacc").alias("hFacC"))
    with _written(spark) as folder:
        chunks.write_chunks(cells, folder, ["Theta", "hFacC"], block=TILE)
        read = chunks.read_chunks(spark, folder, iterations=[10000], faces=[0, 5, 7, 12], j=(10, 300), i=(3, 28))
        return _kept(_round(read, "Theta", "hFacC"))


def references(spark, d):
    """A JSON reference file for each nation, listed, read and parsed."""
    n = tables.table(spark, d, "nation")
    doc = F.to_json(F.struct(F.lit(1).alias("version"), F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("refs")))
    with _written(spark) as folder:
        n.select(F.col("n_nationkey").alias("nation"), doc.alias("value")).repartition("nation").write.partitionBy("nation").text(folder)
        listed = readers.list_objects(spark, folder, "*.txt")
        read = readers.read_references(spark, folder).select("path", F.try_variant_get("content", "$.refs.name", "string").alias("name"), F.try_variant_get("content", "$.refs.region", "int").alias("region"))
        tail = lambda c: F.element_at(F.split(c, "/"), -2)
        key = F.regexp_extract(tail(F.col("path")), r"nation=(\d+)", 1).cast("int")
        return _kept(listed.select(key.alias("nation"), (F.col("pos") >= 0).alias("listed")).join(read.select(key.alias("nation"), "name", "region"), "nation"))


def object_paths(spark, d):
    k = tables.table(spark, d, "nation").select((F.col("n_nationkey") % 13).cast("int").alias("face"), "n_nationkey")
    return k.select("n_nationkey", readers.snapshot_path("bucket/f%d/it_%010d.json", 10000, "face").alias("path"))


def density_surface(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", eos.density("salt", "theta").alias("rho")), "rho")


def density_pressure(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", eos.density("salt", "theta", F.col("j") * 50.0).alias("rho")), "rho")


def bulk_modulus(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", eos.bulk_modulus("salt", "theta", F.col("j") * 5.0).alias("k")), "k")


def buoyancy(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", (eos.buoyancy() * 1e3).alias("b")), "b")


def observed_negative_salinity(spark, d):
    """The same count, taken on the side while another action runs over the rows."""
    rows, seen = eos.observed(tables.cells(spark, d).withColumn("salt", F.col("salt") - 34.0))
    rows.select(eos.density("salt", "theta")).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["negative_salinity"],)], "negative_salinity BIGINT")


def gradient_attributes(spark, d):
    """The names and units that go with a gradient's columns, and how many values each has."""
    g = stencil.tracer_gradient(tables.cells(spark, d), "theta", long_name="potential temperature", units="K/m")
    named = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.metadata.get("long_name")).alias("long_name"), F.lit(f.metadata.get("units")).alias("units"), F.count(f.name).alias("n")) for f in g.schema if f.name in ("zonal", "merid")])
    return g.agg(named.alias("a")).select(F.inline("a"))


def negative_salinity(spark, d):
    return eos.negative_salinity(tables.cells(spark, d).withColumn("salt", F.col("salt") - 34.0))


def diff_x(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", stencil.left_difference("theta", "i").alias("d")), "d")


def diff_y(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", stencil.left_difference("theta", "j", "extend").alias("d")), "d")


def interp_fill(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", stencil.centre_mean("theta", "i").alias("m")), "m")


def gradient_native(spark, d):
    g = stencil.tracer_gradient(tables.cells(spark, d), "theta", long_name="potential temperature", units="K/m")
    return _round(g.select("face", "j", "i", (F.col("zonal") * 1e3).alias("zonal"), (F.col("merid") * 1e3).alias("merid")), "zonal", "merid")


def gradient_linked(spark, d):
    """The gradient with neighbours across the seams of faces."""
    g = seams.linked_gradient(tables.cells(spark, d), "theta", seams.face_links(spark, SEAMS))
    return _round(g.select("face", "j", "i", (F.col("zonal") * 1e3).alias("zonal"), (F.col("merid") * 1e3).alias("merid")), "zonal", "merid")


def seam_vectors(spark, d):
    """A vector of two variables in the cells across every seam, in the axes of the face that they enter."""
    across = seams.ghosts(tables.cells(spark, d), seams.face_links(spark, SEAMS), ["theta", "salt"])
    return _round(seams.turned(across, "theta", "salt").select("face", "j", "i", "side", "theta", "salt"), "theta", "salt")


def grad_squared(spark, d):
    """The flagship: grid, buoyancy, native gradient, squared, then figures per face."""
    per_face = _field(spark, d).groupBy("face").agg(F.count("g2").alias("n"), F.max(F.col("g2") * 1e9).alias("g2_max"), F.avg(F.col("g2") * 1e9).alias("g2_mean"))
    return _round(per_face, "g2_max", "g2_mean")


def _price(spark, d):
    return tables.table(spark, d, "lineitem").select(F.log10("l_extendedprice").alias("v"))


def compute_pdf(spark, d):
    return _round(stats.probability_table(_price(spark, d), "v", 200), "lo", "hi", "pdf", "cdf")


def approximate_quantiles(spark, d):
    """Whether the sketch's limits lie within a thousandth of the ranks asked for."""
    v = _price(spark, d)
    q = stats.quantiles(v, "v", 0.1, 0.9, approximate=True)
    share = lambda c: F.avg((F.col("v") <= F.col(c)).cast("double"))
    near = v.crossJoin(F.broadcast(q)).agg((F.abs(share("vmin") - 0.1) < 0.001).alias("low_ok"), (F.abs(share("vmax") - 0.9) < 0.001).alias("high_ok"))  # one row of limits
    return near


def quantile_summaries(spark, d):
    """Limits over all faces from stored summaries of each, and how far their ranks are from what was asked."""
    cells = tables.cells(spark, d)
    with _written(spark) as folder:
        summaries.summarise(cells, "theta", ["face"], SUMMARY, TILE).write.parquet(folder)
        limits = summaries.quantiles(summaries.merge(spark.read.parquet(folder), [], SUMMARY), [0.01, 0.1, 0.5, 0.9, 0.99])
        return _kept(_round(summaries.rank_errors(cells, "theta", limits), "v", "error"))


def log_range(spark, d):
    return _round(stats.log_range(tables.table(spark, d, "lineitem"), "l_discount"), "vmin", "vmax")


def density_hist(spark, d):
    return _round(stats.magnitude_density(tables.table(spark, d, "events"), "value"), "lo", "hi", "density")


def log_density_hist(spark, d):
    return _round(stats.log_magnitude_density(tables.table(spark, d, "events"), "value"), "lo", "hi", "density")


def face_minmax(spark, d):
    return _round(stats.face_range(tables.cells(spark, d), "theta"), "vmin", "vmax")


def face_mean_spacing(spark, d):
    return _round(stats.face_spacing_km(tables.geometry(spark, d)), "dx_km", "dy_km")


def size_estimate(spark, d):
    return stats.size_bytes(tables.geometry(spark, d))


def mosaic_layout(spark, d):
    """The slots of the faces that are there, with their cells."""
    return mosaic.place(tables.cells(spark, d).groupBy("face").agg(F.count("*").alias("n")))


def log_field_mosaic(spark, d):
    return _round(mosaic.log_mosaic(tables.cells(spark, d), "theta"), "log_v", "vmin", "vmax")


def face_slice(spark, d):
    return _round(mosaic.face_slice(tables.cells(spark, d), 7, "theta"), "theta")


def face_two_vars(spark, d):
    c = tables.cells(spark, d)
    return _round(mosaic.two_variables(c, c, 7, "theta", "salt"), "left_v", "right_v")


def halo_mask_euclid(spark, d):
    return halo.euclid(_masked(spark, d), tables.geometry(spark, d), HALO_KM)


def halo_mask_fmm(spark, d):
    """The halo by marched distance, on blocks that exchange borders."""
    return halo.marched(_masked(spark, d), tables.geometry(spark, d), HALO_KM, TILE)


def weighted_sample(spark, d):
    return _samples(spark, d)


def weighted_sample_half(spark, d):
    """Half of all cells, chosen by the key of that rank and ordered in ranges."""
    cells = tables.cells(spark, d).select("face", "j", "i", F.col("theta").alias("v"))
    return sampling.weighted_sample(cells, cells.count() // 2, BIAS, seed=SEED, strict=False, together=1000).withColumn("sample_rank", F.col("sample_rank").cast("bigint"))


def weighted_sample_by_column(spark, d):
    """The strength of the bias depends on the cell."""
    cells = tables.cells(spark, d).select("face", "j", "i", F.col("theta").alias("v"))
    return sampling.weighted_sample(cells, SAMPLES, F.when(F.col("face") < 6, 0.25).otherwise(0.75), seed=SEED).withColumn("sample_rank", F.col("sample_rank").cast("bigint"))


def sample_weights(spark, d):
    w = sampling.weights(tables.cells(spark, d).select("face", "j", "i", F.col("theta").alias("v")), BIAS)
    return _round(w.select("face", "j", "i", "w", (F.col("p") * 1e6).alias("p")), "w", "p")


def uniform_sample(spark, d):
    return sampling.uniform_sample(tables.cells(spark, d).select("face", "j", "i"), SAMPLES, "face", "j", "i", seed=SEED)


def linear_bin_counts(spark, d):
    """How many of a pool each bin of the prices gets, beside what it holds."""
    held = stats.probability_table(_price(spark, d), "v", 10).select("bin", F.col("n").alias("held"))
    return sampling.linear_bin_counts(spark, 1000, 10, 0, 100.0).join(held, "bin")


def linear_sample(spark, d):
    return _round(sampling.linear_sample(stats.probability_table(_price(spark, d), "v", 10), 1000, 10, 0, 100.0, SEED), "v")


def inverse_transform_sample(spark, d):
    return _round(sampling.inverse_transform_sample(stats.probability_table(_price(spark, d), "v", 50), 500, SEED), "v")


def sample_on_pdf(spark, d):
    return _round(sampling.sample_on_pdf(_price(spark, d), "v", 100, seed=SEED), "v")


def first_match_tolerance(spark, d):
    part = tables.table(spark, d, "part")
    asked = part.select(F.col("p_partkey").alias("sample_id"), (F.col("p_retailprice") + F.when(F.col("p_partkey") % 2 == 0, 0.0).otherwise(1e7)).alias("s"))
    return sampling.first_match(part, asked, "p_retailprice", "p_partkey", 0.01)


def extent_i(spark, d):
    return _round(patches.extent(_samples(spark, d), tables.geometry(spark, d), "i", PATCH_KM / 2), "real_km")


def extent_j(spark, d):
    return _round(patches.extent(_samples(spark, d), tables.geometry(spark, d), "j", PATCH_KM / 2), "real_km")


def patch_bounds(spark, d):
    return _round(_bounds(spark, d).where("status = 'ok'").drop("status"), "real_km_w", "real_km_h")


def patch_rejects(spark, d):
    return _bounds(spark, d).groupBy("status").agg(F.count("*").alias("n"))


def image_pixels(spark, d):
    return _round(_pixels(spark, d), "v")


def image_blocks(spark, d):
    """The pixels from a store in blocks, of which only those that patches touch are read."""
    with _written(spark) as folder:
        cells = tables.cells(spark, d).select("face", "j", "i", "theta", "salt")
        side = blocks.side_for(cells, TILE)
        blocks.write_blocks(cells, folder, side)
        return _kept(_round(patches.patch_pixels(blocks.read_blocks(spark, folder), _bounds(spark, d), ["theta", "salt"], block=side), "v"))


def _pooled(spark: SparkSession, d: str) -> DataFrame:
    return patches.pooled(tables.cells(spark, d), _bounds(spark, d), ["theta", "salt"], IMAGE, block=4 * TILE)


def image_downsample(spark, d):
    """Images of patches by summed-area tables of blocks."""
    return _pooled(spark, d).withColumn("v", F.round(F.col("v").cast("double"), 4))


def image_downsample_pixels(spark, d):
    """The same images from pixel rows."""
    return patches.downsample(_pixels(spark, d, with_size=True), IMAGE).withColumn("v", F.round(F.col("v").cast("double"), 4))


def image_tensor(spark, d):
    """Arrays as text, in units of 1e-3, so that the order of their cells is compared too."""
    t = patches.tensors(_pooled(spark, d))
    return t.withColumn("data", F.array_join(F.transform("data", lambda v: F.round(v.cast("double") * 1e3).cast("bigint").cast("string")), ",", "-"))


def image_tensor_pixels(spark, d):
    return _round(patches.tensor_pixels(patches.tensors(_pixels(spark, d))), "v")


def image_dataset_records(spark, d):
    """The whole way from fields to images: each sample's record from the sink, with the mean of its image's first channel."""
    recipe = Recipe(HALO_KM, PATCH_KM, SAMPLES, BIAS, IMAGE, ("theta", "salt"), SEED, TILE)
    records, images = image_dataset(tables.cells(spark, d), recipe)
    means = images.where("channel = 0").groupBy("sample_id").agg(F.avg(F.col("v").cast("double")).alias("mean"), F.count("v").alias("n_pixels"))
    with _written(spark) as folder:
        commit_log.CommitLog(spark, folder).append(records.join(means, "sample_id", "left"), "records")
        return _kept(_round(commit_log.CommitLog(spark, folder).read().select("sample_id", "face", "j", "i", "status", "v", "n_pixels", F.round("mean", 4).alias("mean")), "v", "mean"))


def merge_conflicts(spark, d):
    """Cells that state and geometry give two values for; every tenth geometry has another salinity."""
    state = tables.cells(spark, d).select("face", "j", "i", "theta", "salt")
    grid = tables.cells(spark, d).select("face", "j", "i", "dxc", F.when((F.col("i") + F.col("j")) % 10 == 0, F.col("salt") + 1).when((F.col("i") + F.col("j")) % 10 != 1, F.col("salt")).alias("salt"))
    return model.conflicts(state, grid)


def negative_salinity_faces(spark, d):
    return eos.any_negative_salinity(tables.cells(spark, d).withColumn("salt", F.col("salt") - F.lit(30.0) - F.col("face") / 1000.0))


def metadata_append(spark, d):
    """Two batches, of which the first lacks a column, appended to the sink and read back."""
    e = tables.table(spark, d, "events").select("event_id", F.col("event_type"), F.col("value"))
    with _written(spark) as folder:
        metadata.append(e.where("event_id % 2 = 0").drop("value"), folder)
        metadata.append(e.where("event_id % 2 = 1"), folder)
        return _kept(metadata.read(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("with_value")))


def metadata_stream(spark, d):
    """Events as a stream of files into the logged sink, compacted on the way, then read back."""
    e = tables.table(spark, d, "events").select("event_id", "event_type", "value")
    with _written(spark) as folder:
        e.repartition(6, "event_id").write.parquet(f"{folder}/source")
        arriving = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/source")
        query = commit_log.write_stream(arriving, f"{folder}/sink", f"{folder}/checkpoint", compact_every=2)
        query.awaitTermination()
        read = commit_log.CommitLog(spark, f"{folder}/sink").read(e.schema)
        return _kept(read.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"), F.round(F.sum("value"), 3).alias("total")))


def metadata_union(spark, d):
    e = tables.table(spark, d, "events").select("event_id", F.col("event_type"), F.col("value"))
    first, second = e.where("event_id % 2 = 0").drop("value"), e.where("event_id % 2 = 1")
    return metadata.union(first, second).groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("with_value"))


def metadata_records(spark, d):
    """Records one by one through the buffering writer: missing keys, values that are never there, whole and broken numbers."""
    rows = tables.table(spark, d, "nation").orderBy("n_nationkey").collect()  # 25 rows
    with _written(spark) as folder:
        with metadata.MetadataWriter(spark, folder, flush_every=7) as w:
            for r in rows:
                k = r["n_nationkey"]
                w.add({"nation": k, "name": r["n_name"], "never": None} | ({"size": k if k < 14 else k + 0.5} if k % 3 else {}))
        return _kept(metadata.read(spark, folder).select(F.col("nation").cast("bigint").alias("nation"), "name", "size"))


def hash_uniform(spark, d):
    return _round(tables.cells(spark, d).select("face", "j", "i", uniform("face", "j", "i", SEED).alias("u")), "u")


QUERIES = {
    f.__name__: f
    for f in (
        scan_snapshot, flux_variables, read_stores, read_chunks, references, object_paths, scan_grid, list_theta_files, latest_iteration, last_listed_file, merge_landmask, merge_inner, merge_conflicts, density_surface, density_pressure, bulk_modulus,
        buoyancy, negative_salinity, negative_salinity_faces, observed_negative_salinity, gradient_attributes, diff_x, diff_y, interp_fill, gradient_native, gradient_linked, seam_vectors, grad_squared, compute_pdf, approximate_quantiles, quantile_summaries, log_range, density_hist, log_density_hist,
        face_minmax, face_mean_spacing, size_estimate, mosaic_layout, log_field_mosaic, face_slice, face_two_vars, halo_mask_euclid, halo_mask_fmm,
        weighted_sample, weighted_sample_half, weighted_sample_by_column, sample_weights, uniform_sample, linear_bin_counts, linear_sample, inverse_transform_sample, sample_on_pdf, first_match_tolerance,
        extent_i, extent_j, patch_bounds, patch_rejects, image_pixels, image_blocks, image_downsample, image_downsample_pixels, image_tensor, image_tensor_pixels, image_dataset_records, metadata_append, metadata_stream, metadata_union, metadata_records, hash_uniform,
    )
}
