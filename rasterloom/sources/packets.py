"""Packet streams: a binary data source that splits one large stream between tasks.

A packet is a marker, a header with a checksum of its own, a payload, and a
checksum of all of it. A task is given a range of bytes and returns what starts
in it, whatever the ranges are: it goes back to a byte that no whole packet
spans, and from there reads as a reader of the whole stream would. What is not
part of a whole packet is returned too, as damage, cut at each marker and at
fixed multiples of bytes, so no byte of a stream goes unmentioned and none is
in two rows.
"""

from __future__ import annotations

import binascii
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators import raw_lines
from .tiff import file_system, qualified

#: The attached synchronisation marker of space packets, and what follows it (big-endian):
#: channel, sequence number, imager clock in microseconds, codec, flags, payload bytes; then a 16-bit checksum of these.
MARKER = bytes.fromhex("1ACFFC1D")
FIELDS = struct.Struct(">HIQBBI")
HEAD = len(MARKER) + FIELDS.size + 2
TAIL = 4
#: Longest payload; a header that claims more is damaged.
MAX_PAYLOAD = 1 << 20
#: Damage is cut at multiples of this many bytes.
GRID = 1 << 20
OK, CHECKSUM, HEADER, NOISE = "ok", "checksum", "header", "noise"
SCHEMA = "path string, offset long, length long, status string, channel int, sequence long, time_us long, codec int, flags int, payload binary"


def frame(channel: int, sequence: int, time_us: int, codec: int, flags: int, payload: bytes) -> bytes:
    """One packet."""
    fields = FIELDS.pack(channel, sequence, time_us, codec, flags, len(payload))
    body = MARKER + fields + struct.pack(">H", binascii.crc_hqx(fields, 0xFFFF)) + payload
    return body + struct.pack(">I", zlib.crc32(body))


def _header(data: bytes, at: int) -> tuple | None:
    """The fields of a header at a marker, if they are whole and their checksum holds."""
    fields = data[at + len(MARKER) : at + HEAD - 2]
    if len(fields) < FIELDS.size or data[at + HEAD - 2 : at + HEAD] != struct.pack(">H", binascii.crc_hqx(fields, 0xFFFF)):
        return None
    found = FIELDS.unpack(fields)
    return found if found[-1] <= MAX_PAYLOAD else None


def _end(data: bytes, at: int) -> int:
    """Where the packet at a marker ends if it is whole, else 0."""
    head = _header(data, at)
    if head is None:
        return 0
    stop = at + HEAD + head[-1]
    check = data[stop : stop + TAIL]
    return stop + TAIL if len(check) == TAIL and struct.unpack(">I", check)[0] == zlib.crc32(memoryview(data)[at:stop]) else 0


LONGEST = HEAD + MAX_PAYLOAD + TAIL


class _Window:
    """Bytes [low, high) of an open file, with whole packets found once."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def load(self, low: int, high: int) -> None:
        self.low, self.high = max(0, low), min(self.size, high)
        self.file.seek(self.low)
        self.data = self.file.read(self.high - self.low)

    def markers(self, start: int, stop: int) -> Iterator[int]:
        """Offsets in [start, stop) at which a marker starts."""
        at = self.data.find(MARKER, start - self.low)
        while at >= 0 and at + self.low < stop:
            yield at + self.low
            at = self.data.find(MARKER, at + 1)

    def end(self, at: int) -> int:
        stop = _end(self.data, at - self.low)
        return stop + self.low if stop else 0


def _clean_start(window: _Window, start: int) -> int:
    """The last byte at or before `start` that no whole packet spans; the window then begins there or before."""
    back = LONGEST
    while True:
        window.load(start - back, start + LONGEST)
        # whole packets whose reach is certain: those that start LONGEST bytes inside the window, or in a window that starts the file
        sure = window.low if window.low == 0 else window.low + LONGEST
        spans = [(p, window.end(p)) for p in window.markers(window.low, start)]
        spans = sorted((p, e) for p, e in spans if e)
        at = start
        for p, e in reversed(spans):  # by decreasing start; any that reaches over the point moves it back
            if p < at < e:
                at = p
        while moved := [p for p, e in spans if p < at < e]:
            at = min(moved)
        if at >= sure or window.low == 0:
            return at
        back *= 2


def read_range(file, size: int, start: int, stop: int, step: int = 8 << 20) -> Iterator[tuple]:
    """(offset, length, status, fields, payload) of all that starts in [start, stop), in order."""
    window = _Window(file, size)
    at = _clean_start(window, start - start % GRID)  # a place at which damage is cut, too
    reach = min(stop + GRID, size)  # damage that starts before `stop` ends at the next packet, marker or multiple of GRID
    while at < stop:
        window.load(at, min(at + step, reach) + LONGEST)
        limit = min(at + step, reach)
        damage = at
        for p in window.markers(at, limit):
            if p < at:
                continue  # inside a whole packet
            if stopped := window.end(p):
                yield from _damage(window, damage, p, start, stop)
                if start <= p < stop:
                    fields = _header(window.data, p - window.low)
                    yield p, stopped - p, OK, fields, window.data[p - window.low + HEAD : stopped - window.low - TAIL]
                at = damage = stopped
                if at >= stop:
                    return
        # what is left has no whole packet before `limit`; damage is told up to the last place at which it is cut for sure
        if limit >= size or limit >= reach:
            yield from _damage(window, damage, limit, start, stop)
            return
        if limit > at:
            cut = max([limit - limit % GRID, *window.markers(damage, limit)])
            cut = cut if cut > damage else damage
            yield from _damage(window, damage, cut, start, stop)
            at = cut if cut > damage else at
            if cut == damage and at < limit:
                step *= 2  # the same start again, looking further


def _damage(window: _Window, low: int, high: int, start: int, stop: int) -> Iterator[tuple]:
    """Rows of the bytes [low, high), which hold no whole packet: pieces that begin at a marker, and noise.

    A piece ends at the next marker or multiple of `GRID`, or where its header, if whole, says that its packet ends.
    """
    cuts = sorted({low, high, *window.markers(low, high), *range(low - low % GRID + GRID, high, GRID)})
    for a, b in zip(cuts, cuts[1:], strict=False):
        at = a - window.low
        marked = window.data[at : at + len(MARKER)] == MARKER
        fields = _header(window.data, at) if marked else None
        end = min(b, a + HEAD + fields[-1] + TAIL) if fields else b
        if start <= a < stop:
            yield a, end - a, CHECKSUM if fields else HEADER if marked else NOISE, fields, None
        if end < b and start <= end < stop:
            yield end, b - end, NOISE, None, None


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    stop: int


class PacketReader(DataSourceReader):
    """One partition per file and range of bytes."""

    def __init__(self, paths: list[str], split: int):
        self.paths, self.split = paths, split

    def partitions(self):
        found = []
        for path in self.paths:
            system, inside = file_system(path)
            size = system.get_file_info(inside).size
            found += [ByteRange(path, a, min(size, a + self.split)) for a in range(0, size, self.split)]
        return found or [ByteRange("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        system, inside = file_system(partition.path)
        size = system.get_file_info(inside).size
        rows, held = [], 0
        with system.open_input_file(inside) as file:
            for offset, length, status, fields, payload in read_range(file, size, partition.start, partition.stop):
                rows.append((partition.path, offset, length, status, *(fields[:5] if fields else [None] * 5), payload))
                held += len(payload or b"") + 64
                if held > 4 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


KINDS = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
NAMES = ["path", "offset", "length", "status", "channel", "sequence", "time_us", "codec", "flags", "payload"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class PacketWriter(DataSourceWriter):
    """Writes rows (name, frame), in the order they come, to files `folder`/name; files appear when all tasks are done."""

    def __init__(self, folder: str, job: str):
        self.folder, self.scratch = folder, f"{folder}/_writing-{job}"

    def write(self, iterator):
        task, files, out, now = TaskContext.get(), [], None, None
        system, inside = file_system(self.scratch)
        system.create_dir(inside, recursive=True)
        try:
            for row in iterator:
                if row.name != now:
                    if out:
                        out.close()
                    now, place = row.name, f"{inside}/{task.partitionId()}-{task.taskAttemptId()}-{len(files)}"
                    files.append((place, row.name))
                    out = system.open_output_stream(place)
                out.write(row.frame)
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages):
        system, inside = file_system(self.folder)
        for message in messages:
            for place, name in message.files if message else ():
                system.move(place, f"{inside}/{name}")
        self.abort(messages)

    def abort(self, messages):
        system, inside = file_system(self.scratch)
        if system.get_file_info(inside).type == fs.FileType.Directory:
            system.delete_dir(inside)


class PacketSource(DataSource):
    """Read: option `paths` (newline-separated) and `split_bytes` (64 MB). Write: option `path` (a folder) and `job` (a name of its own)."""

    @classmethod
    def name(cls) -> str:
        return "packets"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return PacketReader([p for p in self.options.get("paths", "").split("\n") if p], int(self.options.get("split_bytes", 64 << 20)))

    def writer(self, schema, overwrite):
        return PacketWriter(self.options["path"].rstrip("/"), self.options["job"])


def read_packets(spark: SparkSession, root: str | list[str], *, split_bytes: int = 64 << 20) -> DataFrame:
    """Packets and damage of one stream, of several, or of all files of a folder.

    Rows: `path`, `offset`, `length`, and `status`: `ok`, `checksum` (a whole
    header, but its packet is damaged or cut off), `header` (a marker whose
    header is damaged), `noise` (bytes before any marker). Fields are null
    where no header could be read, the payload where the packet is not whole.
    An empty stream gives no rows.
    """
    if split_bytes < 1:
        raise ValueError("split_bytes must be positive")
    paths = []
    for path in [root] if isinstance(root, str) else root:
        system, inside = file_system(qualified(spark, path))
        info = system.get_file_info(inside)
        below = system.get_file_info(fs.FileSelector(inside)) if info.type == fs.FileType.Directory else [info]
        prefix = qualified(spark, path).removesuffix(inside)
        paths += sorted(prefix + x.path for x in below if x.is_file and not x.base_name.startswith(("_", ".")))
    spark.dataSource.register(PacketSource)
    return spark.read.format("packets").options(paths="\n".join(paths), split_bytes=split_bytes).load()


def frames(packets: DataFrame, keep: list[str]) -> DataFrame:
    """Add `frame`, the packet's bytes, to rows (channel, sequence, time_us, codec, flags, payload); `keep` are the columns that stay."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in NAMES[4:]]
            made = [frame(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.binary())], [*keep, "frame"])

    kinds = ", ".join(f"`{c}` {packets.schema[c].dataType.simpleString()}" for c in keep)
    return packets.mapInArrow(run, f"{kinds}, frame binary")


def write_frames(framed: DataFrame, folder: str, *, job: str, name: str = "name", order: str = "sequence") -> None:
    """Write rows (name, order, frame) to one file per name below `folder`; a file is written by one task, so large streams take several names."""
    spark = framed.sparkSession
    spark.dataSource.register(PacketSource)
    placed = framed.repartition(name).sortWithinPartitions(name, order).select(F.col(name).alias("name"), "frame")
    placed.write.format("packets").mode("append").options(path=qualified(spark, folder), job=job).save()


def sequence_gaps(packets: DataFrame, keys: list[str], *, span: float = 65_536.0) -> DataFrame:
    """(keys, sequence, missing, repeated) of the packets after which sequence numbers are missing, and of those received more than once.

    Sequence numbers are cut into ranges of `span`, so a channel of any length spreads over many tasks.
    """
    return raw_lines.line_gaps(packets.where(F.col("status") == OK), keys, line="sequence", span=span)
