"""Chunked arrays behind reference files, as a data source of cells.

A reference file is a JSON object of one face and one iteration: array metadata, and for each chunk the place of its bytes
(an object, an offset and a length) or the bytes themselves.  ``chunked_cells`` turns each chunk of cells into one input
partition, so nothing larger than a chunk is ever held, and a task reads only the byte ranges of its own cells.  Iterations
and faces choose reference files by name, ranges of j and i choose chunks, before anything else is opened.

Objects are reached through Arrow's file systems; public stores are read without credentials.
"""

from __future__ import annotations

import base64
import json
import math
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from oceanloom.schema import CELL_KEY

#: How reference files are named, and the dimensions of a cell's row and column.
NAME = re.compile(r"_f(\d+)_k\d+_iter_(\d+)\.json$")
ROW_DIMS, COLUMN_DIMS = ("j", "j_g"), ("i", "i_g")
BLOCK = 720
#: Cells that leave a task in one batch.
CELLS_PER_BATCH = 1 << 16
#: Reference files that are opened at the same time.
OPENED_TOGETHER = 16
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def open_store(uri: str, options: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, and the path in it.  ``endpoint`` and ``anonymous`` are for object stores."""
    if uri.startswith("s3://"):
        known = {"endpoint_override": options.get("endpoint"), "region": options.get("region")}
        return pafs.S3FileSystem(anonymous=options.get("anonymous", "true") == "true", **{k: v for k, v in known.items() if v}), uri[len("s3://") :]
    if re.match("file:/+", uri):
        return pafs.LocalFileSystem(), "/" + re.sub("^file:/+", "", uri)
    return (pafs.LocalFileSystem(), uri) if "://" not in uri else pafs.FileSystem.from_uri(uri)


def decompressed(raw: bytes, codec: dict | None) -> bytes:
    """The chunk's bytes by the named codec; ``ValueError`` for one that isn't known."""
    name = codec["id"] if codec else None
    if name is None:
        return raw
    if name in ("zlib", "gzip"):
        import zlib

        return zlib.decompress(raw, wbits=47)
    if name == "zstd":
        return pa.decompress(raw, decompressed_size=_zstd_size(raw), codec="zstd").to_pybytes()
    if name in ("bz2", "lzma"):
        return __import__(name).decompress(raw)
    raise ValueError(f"unknown codec {name}")


def _zstd_size(raw: bytes) -> int:
    """The size that a zstd frame states of its content."""
    descriptor = raw[4]
    single, flag = descriptor >> 5 & 1, descriptor >> 6
    at = 5 + (0 if single else 1) + (0, 1, 2, 4)[descriptor & 3]
    width = (1 if single else 0, 2, 4, 8)[flag]
    if not width:
        raise ValueError("the frame doesn't state its size")
    return int.from_bytes(raw[at : at + width], "little") + (256 if flag == 1 else 0)


@dataclass
class Variable:
    """One array of a reference file, seen as cells: leading dimensions at index 0."""

    name: str
    shape: tuple[int, int]
    chunks: tuple[int, int]
    lead: int
    dtype: str
    order: str
    codec: dict | None
    fill: float
    separator: str
    refs: dict

    @classmethod
    def of(cls, name: str, refs: dict) -> Variable | None:
        meta, attrs = (json.loads(v) if isinstance(v := refs.get(f"{name}/{k}", "{}"), str) else v for k in (".zarray", ".zattrs"))
        dims = attrs.get("_ARRAY_DIMENSIONS", [])
        if len(dims) < 2 or dims[-2] not in ROW_DIMS or dims[-1] not in COLUMN_DIMS:
            return None
        if meta.get("filters"):
            raise ValueError(f"{name} has filters, which are not supported")
        fill = meta.get("fill_value")
        return cls(name, tuple(meta["shape"][-2:]), tuple(meta["chunks"][-2:]), len(dims) - 2, meta["dtype"], meta.get("order", "C"), meta.get("compressor"), math.nan if fill is None else float(fill), meta.get("dimension_separator", "."), {})

    def key(self, cj: int, ci: int) -> str:
        return f"{self.name}/" + self.separator.join(["0"] * self.lead + [str(cj), str(ci)])


def parsed(doc: dict) -> list[Variable]:
    """The variables of a reference file; the small arrays of coordinates are none."""
    refs = doc.get("refs", doc)
    found = [Variable.of(k.split("/")[0], refs) for k in refs if k.endswith("/.zarray")]
    return sorted((v for v in found if v), key=lambda v: v.name)


@dataclass
class ChunkPartition(InputPartition):
    iteration: int
    face: int
    j0: int
    j1: int
    i0: int
    i1: int
    variables: list[Variable]


@dataclass
class Wanted:
    """What is asked of each key: values, and inclusive bounds."""

    values: dict
    low: dict
    high: dict

    def holds(self, key: str, first: int, last: int) -> bool:
        """Whether any of the whole numbers from first to last is wanted."""
        if last < self.low.get(key, -math.inf) or first > self.high.get(key, math.inf):
            return False
        return key not in self.values or any(first <= v <= last for v in self.values[key])

    def narrow(self, key: str, values: Iterable | None = None, low: float | None = None, high: float | None = None) -> None:
        if values is not None:
            self.values[key] = set(values) & self.values.get(key, set(values))
        if low is not None:
            self.low[key] = max(low, self.low.get(key, -math.inf))
        if high is not None:
            self.high[key] = min(high, self.high.get(key, math.inf))


class ChunkReader(DataSourceReader):
    """One partition for each wanted chunk of cells of the first variable; the others' bytes of the same cells go with it."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.names = options, [f.name for f in schema if f.name not in ("iter", *CELL_KEY)]
        self.wanted = Wanted({}, {}, {})
        for key, option in (("iter", "iterations"), ("face", "faces")):
            if options.get(option):
                self.wanted.narrow(key, values=[int(v) for v in options[option].split(",")])
        for key in ("j", "i"):
            if options.get(key):
                low, high = options[key].split(":")
                self.wanted.narrow(key, low=int(low), high=int(high))

    def partitions(self) -> list[InputPartition]:
        fs, files = reference_files(self.options)
        chosen = [f for f in files if self.wanted.holds("face", f[0], f[0]) and self.wanted.holds("iter", f[1], f[1])]
        with ThreadPoolExecutor(OPENED_TOGETHER) as pool:
            docs = pool.map(lambda f: _document(fs, f[2]), chosen)
            return [p for (face, iteration, _), doc in zip(chosen, docs, strict=True) for p in self._chunks_of(face, iteration, doc)]

    def _chunks_of(self, face: int, iteration: int, doc: dict) -> list[InputPartition]:
        refs, out = doc.get("refs", doc), []
        variables = [v for v in parsed(doc) if v.name.lower() in {n.lower() for n in self.names}]
        if not variables:
            return []
        (nj, ni), (bj, bi) = variables[0].shape, variables[0].chunks
        for j0 in range(0, nj, bj):
            for i0 in range(0, ni, bi):
                j1, i1 = min(j0 + bj, nj), min(i0 + bi, ni)
                if self.wanted.holds("j", j0, j1 - 1) and self.wanted.holds("i", i0, i1 - 1):
                    out.append(ChunkPartition(iteration, face, j0, j1, i0, i1, [_with_refs(v, refs, doc.get("templates", {}), j0, j1, i0, i1) for v in variables]))
        return out

    def read(self, partition: ChunkPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was chosen
            return
        p = partition
        held = {v.name.lower(): self._cells(v, p) for v in p.variables}
        rows = max(1, CELLS_PER_BATCH // (p.i1 - p.i0))
        for j in range(p.j0, p.j1, rows):
            n, end = (min(j + rows, p.j1) - j) * (p.i1 - p.i0), min(j + rows, p.j1)
            columns = [pa.array(np.full(n, p.iteration, np.int64)), pa.array(np.full(n, p.face, np.int32)), pa.array(np.repeat(np.arange(j, end, dtype=np.int32), p.i1 - p.i0)), pa.array(np.tile(np.arange(p.i0, p.i1, dtype=np.int32), end - j))]
            for name in self.names:
                v = held.get(name.lower())
                part = v[j - p.j0 : end - p.j0].ravel() if v is not None else np.full(n, math.nan)
                columns.append(pa.array(part, pa.float64(), mask=np.isnan(part)))
            yield pa.RecordBatch.from_arrays(columns, ["iter", *CELL_KEY, *self.names])

    def _cells(self, v: Variable, p: ChunkPartition) -> np.ndarray:
        out = np.full((p.j1 - p.j0, p.i1 - p.i0), math.nan)
        (bj, bi), (nj, ni) = v.chunks, v.shape
        for cj in range(p.j0 // bj, -(-min(p.j1, nj) // bj)):
            for ci in range(p.i0 // bi, -(-min(p.i1, ni) // bi)):
                ref = v.refs.get(v.key(cj, ci))
                # Chunks have their full size also where the array ends within one.
                chunk = np.full((bj, bi), v.fill) if ref is None else np.frombuffer(decompressed(self._bytes(ref), v.codec), v.dtype).reshape((bj, bi), order=v.order).astype(float)
                if not math.isnan(v.fill):
                    chunk = np.where(chunk == v.fill, math.nan, chunk)
                j0, j1, i0, i1 = max(p.j0, cj * bj), min(p.j1, (cj + 1) * bj, nj), max(p.i0, ci * bi), min(p.i1, (ci + 1) * bi, ni)
                out[j0 - p.j0 : j1 - p.j0, i0 - p.i0 : i1 - p.i0] = chunk[j0 - cj * bj : j1 - cj * bj, i0 - ci * bi : i1 - ci * bi]
        return out

    def _bytes(self, ref) -> bytes:
        if isinstance(ref, str):
            return base64.b64decode(ref[len("base64:") :]) if ref.startswith("base64:") else ref.encode("latin-1")
        fs, path = open_store(ref[0], self.options)
        with fs.open_input_file(path) as f:
            return f.read() if len(ref) == 1 else f.read_at(ref[2], ref[1])


class PushingChunkReader(ChunkReader):
    """Also takes filters of the query; all of them are still evaluated on the rows."""

    def pushFilters(self, filters: list) -> Iterable:
        for f in filters:
            key = getattr(f, "attribute", (None,))[0]
            if key not in ("iter", *CELL_KEY):
                continue
            if isinstance(f, EqualTo):
                self.wanted.narrow(key, values=[f.value])
            elif isinstance(f, In):
                self.wanted.narrow(key, values=f.value)
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.wanted.narrow(key, low=f.value + isinstance(f, GreaterThan))
            elif isinstance(f, LessThan | LessThanOrEqual):
                self.wanted.narrow(key, high=f.value - isinstance(f, LessThan))
        return filters


def _with_refs(v: Variable, refs: dict, templates: dict, j0: int, j1: int, i0: int, i1: int) -> Variable:
    """The variable with the references of the chunks that overlap the cells."""
    (bj, bi), held = v.chunks, {}
    for cj in range(j0 // bj, -(-j1 // bj)):
        for ci in range(i0 // bi, -(-i1 // bi)):
            ref = refs.get(v.key(cj, ci))
            if isinstance(ref, list):
                url = ref[0]
                for name, value in templates.items():
                    url = url.replace("{{" + name + "}}", value)
                ref = [url, *ref[1:]]
            if ref is not None:
                held[v.key(cj, ci)] = ref
    return Variable(v.name, v.shape, v.chunks, v.lead, v.dtype, v.order, v.codec, v.fill, v.separator, held)


def _document(fs: pafs.FileSystem, path: str) -> dict:
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def reference_files(options: dict[str, str]) -> tuple[pafs.FileSystem, list[tuple[int, int, str]]]:
    """``(face, iteration, path)`` of the reference files of a folder, by name; nothing is opened."""
    fs, folder = open_store(options["path"], options)
    listed = fs.get_file_info(pafs.FileSelector(folder, recursive=True))
    found = [(int(m[1]), int(m[2]), f.path) for f in listed if f.type == pafs.FileType.File and (m := NAME.search(f.path))]
    return fs, sorted(found)


class ChunkedCells(DataSource):
    """``iter, face, j, i`` and a double for each array over cells."""

    @classmethod
    def name(cls) -> str:
        return "chunked_cells"

    def schema(self) -> T.StructType:
        fs, files = reference_files(self.options)
        names = []
        if files:
            names = [v.name for v in parsed(_document(fs, files[0][2]))]
        key = [T.StructField("iter", T.LongType()), *(T.StructField(c, T.IntegerType()) for c in CELL_KEY)]
        return T.StructType([*key, *(T.StructField(n, T.DoubleType()) for n in names)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return (PushingChunkReader if self.options.get("pushing") == "true" else ChunkReader)(dict(self.options), schema)


def read_chunks(
    spark: SparkSession, path: str, iterations: Iterable[int] | None = None, faces: Iterable[int] | None = None, j: tuple[int, int] | None = None, i: tuple[int, int] | None = None,
    variables: list[str] | None = None, endpoint: str | None = None, region: str | None = None, anonymous: bool = True,
) -> DataFrame:
    """Cells of the reference files below ``path``; missing values and fill values are NULL.

    Only reference files of the iterations and faces asked for are opened, and only chunks that touch the inclusive ranges of j
    and i.  Where the session has ``spark.sql.python.filterPushdown.enabled`` on, filters on these four columns choose as well.
    With ``variables`` no other variable's bytes are read.
    """
    spark.dataSource.register(ChunkedCells)
    given = {
        "iterations": iterations is not None and (",".join(map(str, iterations)) or "-1"), "faces": faces is not None and (",".join(map(str, faces)) or "-1"), "j": j and f"{j[0]}:{j[1]}", "i": i and f"{i[0]}:{i[1]}",
        "endpoint": endpoint, "region": region, "anonymous": str(anonymous).lower(), "pushing": str(spark.conf.get(PUSHDOWN, "false")).lower(),
    }
    reader = spark.read.format("chunked_cells").options(**{k: v for k, v in given.items() if v})
    if variables is not None:
        reader = reader.schema("iter BIGINT, face INT, j INT, i INT" + "".join(f", `{v}` DOUBLE" for v in variables))
    rows = reader.load(path)
    for name, bounds in (("j", j), ("i", i)):
        rows = rows.where(F.col(name).between(*bounds)) if bounds else rows
    return rows


def write_chunks(df: DataFrame, path: str, variables: list[str], prefix: str = "cells", block: int = BLOCK, codec: str | None = "zlib") -> None:
    """Writes cells as chunk objects and reference files.

    Each block of cells is one object, its variables' chunks one after the other; a task holds one block.  Names depend on the
    cells alone, so a task that runs again writes the same object.  Cells that are missing from a block are NaN.
    """
    import zlib

    size = F.broadcast(df.groupBy("iter", "face").agg((F.max("j") + 1).alias("nj"), (F.max("i") + 1).alias("ni")))  # a row for each face
    blocks = df.select("iter", *CELL_KEY, *[F.col(v).cast("double").alias(v) for v in variables], F.floor(F.col("j") / block).cast("int").alias("jb"), F.floor(F.col("i") / block).cast("int").alias("ib"))

    def put(group: pa.Table) -> pa.Table:
        it, face, jb, ib = (group.column(c)[0].as_py() for c in ("iter", "face", "jb", "ib"))
        at = (group.column("j").to_numpy() - jb * block, group.column("i").to_numpy() - ib * block)
        url, out, raw = f"{path}/chunks/it{it}_f{face}_{jb}_{ib}", [], b""
        for v in variables:
            cells = np.full((block, block), math.nan, "<f8")
            cells[at] = group.column(v).to_numpy(zero_copy_only=False).astype(float)
            part = zlib.compress(cells.tobytes()) if codec else cells.tobytes()
            out.append((it, face, f"{v}/0.0.{jb}.{ib}", url, len(raw), len(part)))
            raw += part
        fs, name = open_store(url, {})
        fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(name) as f:
            f.write(raw)
        types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["iter", "face", "key", "url", "start", "length"])

    def refer(group: pa.Table) -> pa.Table:
        it, face, nj, ni = (group.column(c)[0].as_py() for c in ("iter", "face", "nj", "ni"))
        refs = {}
        for v in variables:
            array = {"zarr_format": 2, "shape": [1, 1, nj, ni], "chunks": [1, 1, block, block], "dtype": "<f8", "order": "C", "compressor": {"id": codec} if codec else None, "fill_value": "NaN", "filters": None}
            refs[f"{v}/.zarray"], refs[f"{v}/.zattrs"] = json.dumps(array), json.dumps({"_ARRAY_DIMENSIONS": ["time", "k", "j", "i"]})
        refs |= {r["key"]: [r["url"], r["start"], r["length"]] for r in group.to_pylist()}
        fs, name = open_store(f"{path}/{prefix}_f{face}_k0_iter_{it}.json", {})
        with fs.open_output_stream(name) as f:
            f.write(json.dumps({"version": 1, "refs": refs}).encode())
        return pa.table({"n": pa.array([len(refs)], pa.int64())})

    placed = blocks.groupBy("iter", "face", "jb", "ib").applyInArrow(put, "iter BIGINT, face INT, key STRING, url STRING, start BIGINT, length BIGINT")
    placed.join(size, ["iter", "face"]).groupBy("iter", "face").applyInArrow(refer, "n BIGINT").write.format("noop").mode("overwrite").save()
