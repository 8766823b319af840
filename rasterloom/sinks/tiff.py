"""Tiled TIFF output.

Tile rows are encoded in parallel: a group is one band's `block` lines, which
become its tiles at full size and, as averages, at every overview factor (an
overview's tiles are as much lower, so that no group needs a neighbour's
lines). Sizes of tiles, summed up, give each its place in the file, and a Spark
data source for writing puts them there; files are renamed to their final
places when all tasks are done, so a task that is repeated or run twice leaves
no trace.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.preview import OVERVIEW_FACTORS
from ..sources import tiff as source


@dataclass(frozen=True)
class TiffOptions:
    compress: str = "deflate"
    block: int = 512
    overviews: bool = True
    factors: tuple[int, ...] = OVERVIEW_FACTORS
    suffix: str = ".tif"
    nodata: float | None = float("nan")
    dtype: str = "float32"

    def levels(self) -> tuple[int, ...]:
        return (1, *(self.factors if self.overviews else ()))


def average_blocks(values: np.ndarray, factor: int) -> np.ndarray:
    """Averages of the finite values of factor x factor blocks (partial ones at the edges); NaN where there is none."""
    height, width = values.shape
    padded = np.full((-(-height // factor) * factor, -(-width // factor) * factor), np.nan)
    padded[:height, :width] = np.where(np.isfinite(values), values, np.nan)
    boxes = padded.reshape(padded.shape[0] // factor, factor, padded.shape[1] // factor, factor)
    good = np.isfinite(boxes)
    count = good.sum(axis=(1, 3))
    total = np.where(good, boxes, 0.0).sum(axis=(1, 3))
    return np.where(count > 0, total / np.maximum(count, 1), np.nan).astype(values.dtype)


def encode_tile(values: np.ndarray, height: int, width: int, options: TiffOptions) -> bytes:
    """One tile, padded to its size, predicted (3 for reals, 2 otherwise) and compressed."""
    tile = np.zeros((height, width), dtype=values.dtype)
    tile[: values.shape[0], : values.shape[1]] = values
    if options.compress != "deflate":
        return source.apply_predictor(tile, 1)
    return zlib.compress(source.apply_predictor(tile, 3 if values.dtype.kind == "f" else 2), 6)


@dataclass
class Directory:
    """One image of a file: tag values, to be laid out when its place is known."""

    width: int
    height: int
    tile_width: int
    tile_height: int
    offsets: list[int]
    sizes: list[int]
    overview: bool
    options: TiffOptions = field(default_factory=TiffOptions)

    def encode(self, at: int, last: bool, big: bool) -> bytes:
        """The directory and its long values, to be written at byte `at`; the next directory follows directly unless this is the last."""
        dtype, deflate = np.dtype(self.options.dtype), self.options.compress == "deflate"
        word, entry_size = ("Q", 20) if big else ("I", 12)
        long_ = (16, "Q") if big else (4, "I")
        nodata = b"" if self.options.nodata is None else (b"nan" if self.options.nodata != self.options.nodata else f"{self.options.nodata:g}".encode()) + b"\0"
        entries = [
            (254, 4, "I", [int(self.overview)]), (source.WIDTH, 4, "I", [self.width]), (source.HEIGHT, 4, "I", [self.height]), (source.BITS, 3, "H", [dtype.itemsize * 8]),
            (source.COMPRESSION, 3, "H", [8 if deflate else 1]), (262, 3, "H", [1]), (277, 3, "H", [1]), (source.PREDICTOR, 3, "H", [(3 if dtype.kind == "f" else 2) if deflate else 1]),
            (source.TILE_WIDTH, 3, "H", [self.tile_width]), (source.TILE_HEIGHT, 3, "H", [self.tile_height]), (source.TILE_OFFSETS, *long_, self.offsets),
            (source.TILE_SIZES, 4, "I", self.sizes), (source.SAMPLE_FORMAT, 3, "H", [{"u": 1, "i": 2, "f": 3}[dtype.kind]]), (source.NODATA, 2, "s", nodata),
        ]
        entries = [e for e in entries if len(e[3])]
        head = struct.pack("<" + ("Q" if big else "H"), len(entries))
        size = len(head) + len(entries) * entry_size + struct.calcsize(word)
        body, tail = b"", b""
        for tag, kind, code, values in entries:
            data = values if kind == 2 else struct.pack(f"<{len(values)}{code}", *values)
            room = struct.calcsize(word)
            if len(data) > room:
                tail += b"\0" * (len(tail) % 2)
                place, data = struct.pack("<" + word, at + size + len(tail)), tail.__class__(data)
                tail += data
                data = place
            body += struct.pack("<HH", tag, kind) + struct.pack("<" + word, len(values)) + data.ljust(room, b"\0")
        total = size + len(tail) + len(tail) % 2
        following = 0 if last else at + total
        return (head + body + struct.pack("<" + word, following) + tail).ljust(total, b"\0")


def file_head(layout: list[dict], height: int, width: int, options: TiffOptions) -> bytes:
    """Everything before the tiles. `layout` has (level, row, column, size) of all tiles in file order."""
    data_size = sum(t["size"] for t in layout)
    big = data_size > 3_900_000_000
    start = 16 if big else 8

    def build(base: int) -> bytes:
        at, place, out = start, base, b""
        levels = options.levels()
        for n, factor in enumerate(levels):
            sizes = [t["size"] for t in layout if t["level"] == factor]
            offsets = (np.cumsum([0, *sizes])[:-1] + place).tolist()
            place += sum(sizes)
            one = Directory(-(-width // factor), -(-height // factor), options.block, options.block // factor, offsets, sizes, factor > 1, options)
            piece = one.encode(at, n == len(levels) - 1, big)
            at += len(piece)
            out += piece
        return out

    directories = len(build(0))
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, start) if big else struct.pack("<2sHI", b"II", 42, start)
    return head + build(start + directories)


def encode_tiles(lines: DataFrame, keys: list[str], options: TiffOptions, value: str = "radiance") -> DataFrame:
    """(keys, level, row, column, height, width, data) from line rows (keys, line, height, width, value array)."""
    if options.block % 16 or any((options.block // f) % 16 or options.block % f for f in options.levels()):
        raise ValueError("block must be a multiple of 16 at every overview factor")
    kinds = [lines.schema[k].dataType.simpleString() for k in keys]
    dealt = lines.select(*keys, "line", "height", "width", F.col(value).alias("values"), F.floor(F.col("line") / options.block).cast("int").alias("row"))

    def encode(key, table):
        names = [*keys, "level", "row", "column", "height", "width", "data"]
        *own, row = [k.as_py() for k in key]
        height, width = table.column("height")[0].as_py(), table.column("width")[0].as_py()
        place = table.column("line").to_numpy() - row * options.block
        given = table.column("values").combine_chunks()
        block = np.full((min(options.block, height - row * options.block), width), np.nan if np.dtype(options.dtype).kind == "f" else 0, dtype=options.dtype)
        if (np.asarray(given.value_lengths()) != width).any() or (place < 0).any() or (place >= len(block)).any():
            raise ValueError("a line does not fit its raster")
        block[place] = given.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        rows = []
        for factor in options.levels():
            level = block if factor == 1 else average_blocks(block, factor)
            for column in range(-(-level.shape[1] // options.block)):
                part = level[:, column * options.block : (column + 1) * options.block]
                rows.append((*own, factor, row, column, height, width, encode_tile(part, options.block // factor, options.block, options)))
        return pa.table({n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)}).cast(target)

    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    target = pa.schema([*((k, arrow[t]) for k, t in zip(keys, kinds, strict=True)), *((n, pa.int32()) for n in ("level", "row", "column", "height", "width")), ("data", pa.binary())])
    schema = ", ".join([*(f"{k} {t}" for k, t in zip(keys, kinds, strict=True)), "level int, row int, column int, height int, width int, data binary"])
    return dealt.groupBy(*keys, "row").applyInArrow(encode, schema)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: where they are, and where they belong."""

    files: list[tuple[str, str]]


class TileWriter(DataSourceWriter):
    """Writes rows (path, at, data): bytes and where in the file they go.

    In a file system of files that can be written anywhere (scheme `file`), all
    tasks write into the same scratch file, each at its places; a repeated task
    writes the same bytes there again. In others, a file's rows must come to
    one task in order, and each attempt has a scratch file of its own. Either
    way files move to their final places when all tasks are done, and the file
    that was there before stays until then.
    """

    def __init__(self, folder: str, job: str):
        self.scratch = f"{folder}/_writing-{job}"

    def write(self, iterator):
        system, scratch = source.file_system(self.scratch)
        system.create_dir(scratch, recursive=True)
        put = self._anywhere if isinstance(system, fs.LocalFileSystem) else self._in_order
        return Written(put(iterator, system, scratch))

    def _anywhere(self, iterator, system, scratch):
        files: dict[str, tuple[str, int]] = {}
        try:
            for row in iterator:
                if row.path not in files:
                    place = f"{scratch}/{row.path.rpartition('/')[2]}"
                    files[row.path] = (place, os.open(place, os.O_WRONLY | os.O_CREAT, 0o666))
                left, at = memoryview(row.data), row.at
                while len(left):
                    done = os.pwrite(files[row.path][1], left, at)
                    left, at = left[done:], at + done
        finally:
            for _, number in files.values():
                os.close(number)
        return [(place, path) for path, (place, _) in files.items()]

    def _in_order(self, iterator, system, scratch):
        task, files, out, at = TaskContext.get(), [], None, 0
        try:
            for row in iterator:
                if not files or files[-1][1] != row.path:
                    if out:
                        out.close()
                    files.append((f"{scratch}/{task.partitionId()}-{task.taskAttemptId()}-{len(files)}", row.path))
                    out, at = system.open_output_stream(files[-1][0]), 0
                if row.at != at:
                    raise ValueError("the bytes of a file must come in order")
                out.write(row.data)
                at += len(row.data)
        finally:
            if out:
                out.close()
        return files

    def commit(self, messages):
        system, scratch = source.file_system(self.scratch)
        for place, path in sorted({pair for message in messages if message for pair in message.files}):
            target = source.file_system(path)[1]
            if system.get_file_info(target).is_file:
                system.move(target, f"{scratch}/before-{target.rpartition('/')[2]}")
            system.move(place, target)
        self.abort(messages)

    def abort(self, messages):
        system, scratch = source.file_system(self.scratch)
        if system.get_file_info(scratch).type == fs.FileType.Directory:
            system.delete_dir(scratch)


class TileSink(DataSource):
    """Options: `path` (the folder), `job` (a name of its own for each write)."""

    @classmethod
    def name(cls) -> str:
        return "tiff_tiles"

    def writer(self, schema, overwrite):
        return TileWriter(self.options["path"].rstrip("/"), self.options["job"])


def _heads(keys: list[str], kinds: list[str], sized: DataFrame, options: TiffOptions) -> DataFrame:
    """(keys, head): everything before the tiles of each file."""
    layout = F.array_sort(F.collect_list(F.struct("level", "row", "column", "size")))
    files = sized.groupBy(*keys).agg(layout.alias("layout"), F.first("height").alias("height"), F.first("width").alias("width"))

    def run(batches):
        for batch in batches:
            made = [file_head(*row, options) for row in zip(*(batch.column(c).to_pylist() for c in ("layout", "height", "width")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(made, pa.binary())], [*keys, "head"])

    return files.mapInArrow(run, ", ".join([*(f"`{k}` {t}" for k, t in zip(keys, kinds, strict=True)), "head binary"]))


def write_tiff(lines: DataFrame, folder: str, *, name: str = "band", keys: list[str] | None = None, options: TiffOptions = TiffOptions(), value: str = "radiance", scratch: str | None = None) -> DataFrame:
    """Write one file per key to `folder`/<name><suffix>; returns (keys, path) of the files.

    Tiles are encoded once and kept below `scratch`, a shared folder (default:
    below `folder`), until the files are there. The place of a tile in its file
    is the sum of the sizes before it, so all tasks write tiles of all files
    where the file system lets them. The files appear when all are written.
    """
    spark = lines.sparkSession
    keys = keys or [name]
    given, folder, job = folder.rstrip("/"), source.qualified(spark, folder).rstrip("/"), str(uuid.uuid4())
    work = source.qualified(spark, scratch or folder).rstrip("/") + f"/_tiles-{job}"
    encode_tiles(lines, keys, options, value).write.parquet(work)
    tiles = spark.read.parquet(work)
    sized = tiles.select(*keys, "level", "row", "column", "height", "width", F.length("data").cast("long").alias("size"))
    heads = _heads(keys, [lines.schema[k].dataType.simpleString() for k in keys], sized, options).persist()  # a row per file
    before = F.sum("size").over(Window.partitionBy(*keys).orderBy("level", "row", "column")) - F.col("size")  # a row per tile, without its bytes
    placed = sized.withColumn("before", before).join(heads.select(*keys, F.length("head").alias("start")), keys)
    place = placed.select(*keys, "level", "row", "column", (F.col("before") + F.col("start")).alias("at"))
    rows = tiles.join(place, [*keys, "level", "row", "column"]).select(*keys, "at", "data").unionByName(heads.select(*keys, F.lit(0).cast("long").alias("at"), F.col("head").alias("data")))
    if not isinstance(source.file_system(folder)[0], fs.LocalFileSystem):
        rows = rows.repartition(*keys).sortWithinPartitions(*keys, "at")
    where = lambda top: F.concat(F.lit(top + "/"), F.col(name), F.lit(options.suffix)).alias("path")
    spark.dataSource.register(TileSink)
    rows.select(where(folder), "at", "data").write.format("tiff_tiles").mode("append").options(path=folder, job=job).save()
    written = spark.createDataFrame(heads.select(*keys, where(given)).collect(), lines.select(*keys).schema.add("path", "string"))
    heads.unpersist()
    system, inside = source.file_system(work)
    system.delete_dir(inside)
    return written
