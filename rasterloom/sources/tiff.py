"""TIFF rasters: a small codec for single-band images, and a Spark data source that reads blocks of lines.

Each (file, line range) is one input partition; a task reads the header and
the strips or tiles of its lines only, whatever file system the path names.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

# Tag numbers and field types of the TIFF format.
SUBFILE, REDUCED = 254, 1
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS, ROWS_PER_STRIP, STRIP_SIZES = 256, 257, 258, 259, 273, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, SAMPLE_FORMAT, NODATA = 317, 322, 323, 324, 325, 339, 42113
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 5: "Q", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
NO_COMPRESSION, DEFLATE = (1,), (8, 32946)
KINDS = {1: "u", 2: "i", 3: "f"}


@dataclass(frozen=True)
class Header:
    """What a reader needs of one image: its size, type, NoData value and block layout."""

    width: int
    height: int
    dtype: str
    nodata: float | None
    order: str
    deflate: bool
    predictor: int
    block_width: int
    block_height: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    subfile: int = 0


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark resolves it: one without a scheme belongs to the default file system, on whatever machine it is read."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path names, and the path inside it."""
    if "://" not in path and ":/" in path:
        path = path.replace(":/", ":///", 1)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _open(path: str):
    """A seekable input file of whatever file system the path names."""
    system, inside = file_system(path)
    return system.open_input_file(inside)


def read_header(file, directory: int = 0) -> Header:
    """The header of the image (0: full size, then overviews) in an open TIFF or BigTIFF file."""
    start = file.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or struct.unpack(order + "H", start[2:4])[0] not in (42, 43):
        raise ValueError("not a TIFF file")
    big = struct.unpack(order + "H", start[2:4])[0] == 43
    at = struct.unpack(order + "Q", start[8:16])[0] if big else struct.unpack(order + "I", start[4:8])[0]
    count_kind, entry, word = ("Q", 20, "Q") if big else ("H", 12, "I")
    for skip in range(directory + 1):
        if not at:
            raise ValueError("no such image in the file")
        file.seek(at)
        size = struct.calcsize(count_kind)
        count = struct.unpack(order + count_kind, file.read(size))[0]
        body = file.read(count * entry + struct.calcsize(word))
        following = struct.unpack(order + word, body[count * entry :])[0]
        at = at if skip == directory else following
    tags: dict[int, tuple] = {}
    for i in range(count):
        raw = body[i * entry : (i + 1) * entry]
        tag, kind = struct.unpack(order + "HH", raw[:4])
        n = struct.unpack(order + word, raw[4 : 4 + struct.calcsize(word)])[0]
        value = raw[4 + struct.calcsize(word) :]
        if kind not in FIELD:
            continue
        length = n * struct.calcsize(FIELD[kind])
        if length > len(value):
            file.seek(struct.unpack(order + word, value)[0])
            value = file.read(length)
        tags[tag] = (value[:length].rstrip(b"\0").decode("ascii", "replace"),) if kind == 2 else struct.unpack(f"{order}{n}{FIELD[kind]}", value[:length])
    width, height = tags[WIDTH][0], tags[HEIGHT][0]
    compression = tags.get(COMPRESSION, (1,))[0]
    if compression not in NO_COMPRESSION + DEFLATE:
        raise ValueError(f"TIFF compression {compression} is not supported")
    if len(tags.get(BITS, (1,))) > 1:
        raise ValueError("only single-band images are supported")
    tiled = TILE_WIDTH in tags
    nodata = tags.get(NODATA, ("",))[0].strip()
    return Header(
        width, height, KINDS[tags.get(SAMPLE_FORMAT, (1,))[0]] + str(tags.get(BITS, (8,))[0] // 8), float(nodata) if nodata else None, order, compression in DEFLATE,
        tags.get(PREDICTOR, (1,))[0], tags[TILE_WIDTH][0] if tiled else width, tags[TILE_HEIGHT][0] if tiled else min(tags.get(ROWS_PER_STRIP, (height,))[0], height),
        tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_SIZES if tiled else STRIP_SIZES], tags.get(SUBFILE, (0,))[0],
    )


def images(file) -> list[tuple[int, int, int]]:
    """(directory, height, width) of the full image of an open file and of its overviews, the largest first; masks and other pages are left out."""
    found, directory = [], 0
    while True:
        file.seek(0)
        try:
            h = read_header(file, directory)
        except ValueError:
            if not directory:
                raise
            break
        if not directory or h.subfile == REDUCED:
            found.append((directory, h.height, h.width))
        directory += 1
    return sorted(found, key=lambda x: (-x[1] * x[2], x[0]))


def images_of(path: str) -> list[tuple[int, int, int]]:
    """`images` of a file by path."""
    with _open(path) as file:
        return images(file)


def choose_image(sizes: list[tuple[int, int, int]], height: int, width: int) -> tuple[int, int, int]:
    """Of `images`, the smallest that is at least as large as wanted in both directions; the full image if none else is."""
    enough = [x for x in sizes if x[1] >= height and x[2] >= width]
    return enough[-1] if enough else sizes[0]


def undo_predictor(data: bytes, rows: int, width: int, dtype: np.dtype, predictor: int) -> np.ndarray:
    """Samples of one block: predictor 1 none, 2 differences, 3 differences of byte planes (high bytes first)."""
    if predictor == 3:
        planes = np.frombuffer(data, np.uint8).reshape(rows, dtype.itemsize * width)
        planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, dtype.itemsize, width)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(rows, width).astype(dtype.newbyteorder("="))
    values = np.frombuffer(data, dtype).reshape(rows, width).astype(dtype.newbyteorder("="))
    if predictor == 2:
        whole = values.view(f"u{dtype.itemsize}")
        return np.cumsum(whole, axis=1, dtype=whole.dtype).view(values.dtype)
    return values


def apply_predictor(values: np.ndarray, predictor: int) -> bytes:
    """The inverse of `undo_predictor`, little-endian."""
    rows, width = values.shape
    if predictor == 3:
        size = values.dtype.itemsize
        planes = np.ascontiguousarray(values.astype(values.dtype.newbyteorder(">"))).view(np.uint8).reshape(rows, width, size).transpose(0, 2, 1).reshape(rows, size * width)
        return np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
    if predictor == 2:
        whole = values.view(f"u{values.dtype.itemsize}")
        return np.diff(whole, axis=1, prepend=whole.dtype.type(0)).astype(whole.dtype.newbyteorder("<")).tobytes()
    return values.astype(values.dtype.newbyteorder("<")).tobytes()


def read_lines(file, header: Header, start: int, stop: int) -> np.ndarray:
    """Lines [start, stop) of an open file; only the blocks that they touch are read."""
    across = -(-header.width // header.block_width)
    dtype = np.dtype(header.order + header.dtype)
    out = np.zeros((stop - start, header.width), dtype=dtype.newbyteorder("="))
    for row in range(start // header.block_height, -(-stop // header.block_height)):
        top = row * header.block_height
        tall = header.block_height if header.block_width != header.width or len(header.offsets) > -(-header.height // header.block_height) else min(header.block_height, header.height - top)
        for column in range(across):
            i = row * across + column
            left = column * header.block_width
            if header.sizes[i] == 0:  # a block that was never written
                continue
            file.seek(header.offsets[i])
            data = file.read(header.sizes[i])
            data = zlib.decompress(data) if header.deflate else data
            tall_here = min(tall, len(data) // (header.block_width * dtype.itemsize))
            block = undo_predictor(data[: tall_here * header.block_width * dtype.itemsize], tall_here, header.block_width, dtype, header.predictor)
            a, b = max(start, top), min(stop, top + tall_here)
            wide = min(header.block_width, header.width - left)
            out[a - start : b - start, left : left + wide] = block[a - top : b - top, :wide]
    return out


def read_images(paths: DataFrame) -> DataFrame:
    """(path, images): directory, height and width of the full image and the overviews of the rasters in column `path`, read by the executors."""

    def run(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with _open(path) as file:
                    rows.append([dict(zip(("directory", "height", "width"), x, strict=True)) for x in images(file)])
            kind = pa.list_(pa.struct([("directory", pa.int32()), ("height", pa.int32()), ("width", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(rows, kind)], ["path", "images"])

    return paths.select("path").mapInArrow(run, "path string, images array<struct<directory:int,height:int,width:int>>")


def headers(paths: DataFrame) -> DataFrame:
    """(path, width, height, dtype, nodata) of the rasters named in column `path`, read by the executors."""

    def run(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with _open(path) as file:
                    h = read_header(file)
                rows.append((path, h.width, h.height, np.dtype(h.dtype).name, h.nodata))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["path", "width", "height", "dtype", "nodata"])

    return paths.select("path").mapInArrow(run, "path string, width int, height int, dtype string, nodata double")


@dataclass
class LineRange(InputPartition):
    path: str
    start: int
    stop: int


class LineReader(DataSourceReader):
    """Plans one partition per file and block of lines; `path` and `line` filters prune partitions.

    Heights that are given (0: not known) spare the driver a look into each
    file. With a directory other than 0, lines are those of that image, and no
    block of another image is read.
    """

    def __init__(self, paths: list[str], window: int, real: bool, heights: dict[str, int], directory: int = 0):
        self.paths, self.window, self.real, self.heights, self.directory = paths, window, real, heights, directory
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else None
            if name == "path" and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.paths = [p for p in self.paths if p in wanted]
                continue
            if name == "line" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            if name == "line" and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value + (not isinstance(f, LessThan)))
            yield f  # lines are pruned by block, so Spark filters again

    def partitions(self):
        found = []
        for path in self.paths:
            height = self.heights.get(path, 0)
            if not height:
                with _open(path) as file:
                    height = read_header(file, self.directory).height
            for start in range(0, height, self.window):
                stop = min(height, start + self.window)
                if start < self.high and stop > self.low:
                    found.append(LineRange(path, start, stop))
        return found or [LineRange("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        with _open(partition.path) as file:
            header = read_header(file, self.directory)
            step = max(1, (4 << 20) // (4 * header.width))
            for start in range(partition.start, partition.stop, step):
                block = read_lines(file, header, start, min(partition.stop, start + step))
                values = pa.array(block.ravel().astype(np.float32 if self.real else np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1, dtype=np.int32) * header.width), values)
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(block)), pa.array(np.arange(start, start + len(block), dtype=np.int32)), lists], ["path", "line", "values"])


class LineSource(DataSource):
    """Options: `paths` and `heights` (newline-separated), `window_lines` (default 2048, in whole tiles of 512), `real` (read as float), `directory` (default 0, the full image)."""

    @classmethod
    def name(cls) -> str:
        return "tiff_lines"

    def schema(self) -> str:
        return f"path string, line int, values array<{'float' if self._real() else 'int'}>"

    def _real(self) -> bool:
        return self.options.get("real", "false").lower() == "true"

    def reader(self, schema):
        paths = [p for p in self.options.get("paths", "").split("\n") if p]
        heights = [int(h) for h in self.options.get("heights", "").split("\n") if h]
        return LineReader(paths, int(self.options.get("window_lines", 2048)), self._real(), dict(zip(paths, heights, strict=False)), int(self.options.get("directory", 0)))


def read_tiff(spark: SparkSession, paths: list[str], *, window_lines: int = 2048, real: bool = False, heights: list[int] | None = None, directory: int = 0) -> DataFrame:
    """(path, line, values): every line of the rasters, or of an overview of theirs (see `images`).

    Paths are opened by the executors as they are given; `qualified` gives one
    without a scheme that of Spark's default file system. With `heights`, as
    `headers` finds them, the driver opens no file.
    """
    if window_lines < 1:
        raise ValueError("window_lines must be positive")
    spark.dataSource.register(LineSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    options = {"paths": "\n".join(paths), "heights": "\n".join(map(str, heights or [])), "window_lines": window_lines, "real": str(real).lower(), "directory": directory}
    return spark.read.format("tiff_lines").options(**options).load()
