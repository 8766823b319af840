"""PNG previews."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_png(image: np.ndarray) -> bytes:
    """An RGB image (lines, columns, 3) of bytes."""
    height, width, _ = image.shape
    rows = np.zeros((height, 1 + width * 3), dtype=np.uint8)  # each line starts with filter type 0
    rows[:, 1:] = image.reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def collect_image(rgb: DataFrame, height: int, width: int) -> np.ndarray:
    """Pixels (line, col, r, g, b) as an image; the caller bounds height and width. Missing pixels are black."""
    lines = rgb.groupBy("line").agg(F.array_sort(F.collect_list(F.struct("col", "r", "g", "b"))).alias("px"))
    table = lines.select("line", *[F.col(f"px.{c}").alias(c) for c in ("col", "r", "g", "b")]).toArrow()
    image = np.zeros((height, width, 3), dtype=np.uint8)
    for i in range(table.num_rows):
        line, cols = table.column("line")[i].as_py(), table.column("col")[i].values.to_numpy()
        for k, c in enumerate("rgb"):
            image[line, cols, k] = table.column(c)[i].values.to_numpy()
    return image


def collect_channels(lines: DataFrame, channel: str, order: tuple, height: int, width: int) -> np.ndarray:
    """Lines of bytes (channel, line, data) as an image whose channels are those of `order`; the caller bounds height and width. Missing lines are black."""
    image = np.zeros((height, width, len(order)), dtype=np.uint8)
    table = lines.select(channel, "line", "data").toArrow()
    for name, line, data in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True):
        for k in [k for k, wanted in enumerate(order) if wanted == name]:
            image[line, :, k] = np.frombuffer(data, np.uint8)
    return image
