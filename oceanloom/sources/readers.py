"""Snapshot, geometry and listing readers.

Snapshots are Parquet partitioned by ``iter`` and ``face``, so that one
snapshot and a subset of faces prune at file listing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oceanloom.schema import GEOMETRY_VARIABLES, STATE_VARIABLES, SURFACE_FLUX_VARIABLES, nan_to_null

#: Blocks that several stores hold are broadcast up to this many.
MOST_BROADCAST = 200_000
SURFACE_DIMS = ("time_idx", "k", "k_l")
VARIABLE_SETS = {"state": STATE_VARIABLES, "flux": SURFACE_FLUX_VARIABLES}


def surface(df: DataFrame) -> DataFrame:
    """Index 0 of the time and depth dimensions that are there; the filters reach the scan."""
    for dim in SURFACE_DIMS:
        if dim in df.columns:
            df = df.where(F.col(dim) == 0).drop(dim)
    return df


def select_snapshot(df: DataFrame, iteration: int, faces: Iterable[int] | None = None, variables: str = "state") -> DataFrame:
    """Rows of one iteration and the faces asked for, with the variables of the named set that exist."""
    df = surface(df.where(F.col("iter") == F.lit(int(iteration))))
    if faces is not None:
        df = df.where(F.col("face").isin([int(f) for f in faces]))
    names = [c for c in df.columns if c.lower() in VARIABLE_SETS[variables]]
    return nan_to_null(df.select("iter", "face", "j", "i", *names))


def read_snapshot(spark: SparkSession, path: str, iteration: int, faces: Iterable[int] | None = None, variables: str = "state") -> DataFrame:
    return select_snapshot(spark.read.parquet(path), iteration, faces, variables)


def store_extents(stores: list[DataFrame], block: int = 720) -> DataFrame:
    """``face, jb, ib, first, n_stores``: the blocks of cells that the stores hold, the first store that does, and how many do.

    Reads the key columns alone; a row for each block and store leaves a task.
    """
    each = None
    for k, store in enumerate(stores):
        own = store.select("face", *[F.floor(F.col(c) / block).cast("int").alias(b) for b, c in (("jb", "j"), ("ib", "i"))]).distinct().withColumn("_store", F.lit(k))
        each = own if each is None else each.unionByName(own)
    return each.groupBy("face", "jb", "ib").agg(F.min("_store").alias("first"), F.count("*").alias("n_stores"))


def read_snapshots(spark: SparkSession, paths: list[str], iteration: int, faces: Iterable[int] | None = None, block: int = 720, extents: DataFrame | None = None) -> DataFrame:
    """Several stores as one.  Where two hold the same cell the first store wins, without comparing values.

    Each store gives its own surface first, so a cell is one row of each store that holds it, whatever dimensions that store has.
    Stores are compared by the blocks of cells that they hold: only blocks that several hold are put in order, the others
    pass as they are read.  ``extents``, from ``store_extents`` over the same stores, spares finding them.
    """
    stores = [read_snapshot(spark, p, iteration, faces) for p in paths]
    shared = (store_extents(stores, block) if extents is None else extents).where("n_stores > 1").select("face", "jb", "ib")
    found = shared.limit(MOST_BROADCAST + 1).collect() if len(stores) > 1 else []  # blocks, not cells
    whole = None
    for k, store in enumerate(stores):
        part = store.withColumn("_store", F.lit(k))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    if not found:
        return whole.drop("_store")
    blocks = F.broadcast(spark.createDataFrame(found, shared.schema)) if len(found) <= MOST_BROADCAST else shared
    placed = whole.withColumns({b: F.floor(F.col(c) / block).cast("int") for b, c in (("jb", "j"), ("ib", "i"))})
    order = Window.partitionBy("iter", "face", "j", "i").orderBy("_store")
    several = placed.join(blocks, ["face", "jb", "ib"], "left_semi").withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    alone = placed.join(blocks, ["face", "jb", "ib"], "left_anti")
    return alone.unionByName(several).drop("_store", "jb", "ib")


def public_store_options(endpoint: str | None = None, region: str | None = None) -> dict[str, str]:
    """Settings (with the ``spark.hadoop.`` prefix) under which ``s3a://`` paths of a public store are read without credentials."""
    options = {"spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}
    options |= {"spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.path.style.access": "true"} if endpoint else {}
    return options | ({"spark.hadoop.fs.s3a.endpoint.region": region} if region else {})


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return nan_to_null(df.select("face", "j", "i", *[c for c in df.columns if c.lower() in GEOMETRY_VARIABLES]))


def write_partitioned(df: DataFrame, path: str, block: int = 720, mode: str = "overwrite") -> None:
    """Write by iteration and face, dealt by blocks of cells so that no task holds a whole face."""
    cell_block = [F.floor(F.col(c) / block) for c in ("j", "i")]
    df.repartition("iter", "face", *cell_block).sortWithinPartitions("iter", "face", "j", "i").write.mode(mode).partitionBy("iter", "face").parquet(path)


def snapshot_path(template: str, iteration: int, face) -> F.Column:
    """Column of paths from a ``%d``-style template taking face, then iteration."""
    return F.format_string(template, F.col(face) if isinstance(face, str) else F.lit(face), F.lit(iteration))


def list_objects(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``pos, path`` of the objects under ``path``, in name order; reads no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    names = files.select("path")
    # Names only: the file index that the driver already holds has the same size.
    return names.withColumn("pos", F.row_number().over(Window.orderBy("path")).cast("bigint") - 1).select("pos", "path")


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """JSON reference files, one row per file: ``path, content`` as a parsed variant."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return text.select("path", F.try_parse_json("value").alias("content"))


def parse_listing(listing: DataFrame, prefix: str) -> DataFrame:
    """``pos, path, iter`` of the names that are ``{prefix}<face>_k<level>_iter_<number>.json``."""
    name = F.element_at(F.split("path", "/"), -1)
    number = F.regexp_extract(name, f"^{prefix}\\d+_k\\d+_iter_(\\d+)\\.json$", 1)
    return listing.where(name.startswith(prefix)).withColumn("iter", F.when(number != "", number.cast("bigint"))).where(F.col("iter").isNotNull())


def latest(listing: DataFrame, prefix: str) -> DataFrame:
    """The first-listed file of the largest iteration."""
    return parse_listing(listing, prefix).orderBy(F.desc("iter"), F.asc("pos")).limit(1)


def last_listed(listing: DataFrame, prefix: str) -> DataFrame:
    return parse_listing(listing, prefix).orderBy(F.desc("pos")).limit(1)
