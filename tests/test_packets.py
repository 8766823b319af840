"""Packet streams and compressed lines: any split, any damage."""

import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rasterloom.operators import compression
from rasterloom.sources import packets


@pytest.fixture
def short(monkeypatch):
    """Short payloads and a fine grid, so that small streams have every case."""
    for name, value in (("GRID", 64), ("MAX_PAYLOAD", 200), ("LONGEST", packets.HEAD + 200 + packets.TAIL)):
        monkeypatch.setattr(packets, name, value)


def damaged_stream(rng):
    out = b""
    for i in range(rng.randrange(12)):
        payload = rng.randbytes(rng.randrange(120))
        if rng.random() < 0.2:  # a whole packet inside a payload is part of the payload
            payload = packets.frame(9, 9, 9, 0, 0, rng.randbytes(rng.randrange(40))) + payload
        if rng.random() < 0.2:
            payload = packets.MARKER + payload
        made, fate = packets.frame(1, i, i * 10, 0, 0, payload[:200]), rng.random()
        if fate < 0.15:
            at = rng.randrange(len(made))
            made = made[:at] + bytes([made[at] ^ 1 << rng.randrange(8)]) + made[at + 1 :]
        elif fate < 0.25:
            made = made[: rng.randrange(len(made))]
        elif fate < 0.3:
            made = rng.randbytes(rng.randrange(300))
        elif fate < 0.33:
            made = packets.MARKER * rng.randrange(1, 5)
        elif fate < 0.36:
            made = bytes(rng.randrange(400))
        out += made
    return out


def read(data, step, at_once=8 << 20):
    return [r for a in range(0, len(data), step) for r in packets.read_range(io.BytesIO(data), len(data), a, min(len(data), a + step), at_once)]


@pytest.mark.parametrize("seed", range(60))
def test_any_split_gives_the_rows_of_one_reader(short, seed):
    data = damaged_stream(random.Random(seed))
    whole = read(data, max(1, len(data)))
    assert sum(r[1] for r in whole) == len(data)
    assert all(a[0] + a[1] == b[0] for a, b in zip(whole, whole[1:], strict=False))
    for step in (1, 7, 33, 64, 100, 257):
        for at_once in (8 << 20, 50, 90):
            assert read(data, step, at_once) == whole


def test_every_kind_of_damage():
    one = lambda i: packets.frame(3, i, 5 * i, 0, 7, bytes([i]) * 20)
    bad = bytearray(one(2))
    bad[packets.HEAD + 3] ^= 1
    head = bytearray(one(3))
    head[6] ^= 1
    data = b"noise" + one(1) + bytes(bad) + one(4) + bytes(head) + one(5) + one(6)[:-3]
    rows = read(data, len(data))
    assert [(r[2], r[1]) for r in rows if r[2] != "ok"] == [("noise", 5), ("checksum", len(bad)), ("header", len(head)), ("checksum", len(bad) - 3)]
    assert [(r[3][1], r[4]) for r in rows if r[2] == "ok"] == [(i, bytes([i]) * 20) for i in (1, 4, 5)]
    assert rows[2][3][:2] == (3, 2)


def test_streams_through_spark(spark, tmp_path):
    rows = [(f"s{i % 3}.bin", i % 3, i // 3, i, 0, 0, bytes([i % 256]) * (i % 50)) for i in range(600)]
    table = spark.createDataFrame(rows, "name string, channel int, sequence long, time_us long, codec int, flags int, payload binary")
    framed = packets.frames(table, ["name", "sequence"])
    packets.write_frames(framed, str(tmp_path / "raw"), job="a")
    packets.write_frames(framed.where("false"), str(tmp_path / "raw"), job="b")
    assert sorted(x.name for x in (tmp_path / "raw").iterdir()) == ["s0.bin", "s1.bin", "s2.bin"]
    for split in (100, 1 << 20):
        found = packets.read_packets(spark, str(tmp_path / "raw"), split_bytes=split)
        assert {r["status"] for r in found.collect()} == {"ok"}
        assert sorted((r["channel"], r["sequence"], bytes(r["payload"])) for r in found.collect()) == sorted((c, s, p) for _, c, s, _, _, _, p in rows)
    assert packets.read_packets(spark, str(tmp_path / "raw"), split_bytes=100).rdd.getNumPartitions() > 100
    gone = found.where("sequence not in (3, 4, 9)").unionByName(found.where("sequence = 7"))
    gaps = packets.sequence_gaps(gone, ["channel"], span=4.0)
    assert sorted(tuple(r) for r in gaps.collect()) == sorted(x for c in range(3) for x in ((c, 2, 2, 0), (c, 7, 0, 1), (c, 8, 1, 0)))
    with pytest.raises(ValueError, match="positive"):
        packets.read_packets(spark, str(tmp_path), split_bytes=0)


lists = st.lists(st.one_of(st.integers(0, 65535), st.integers(1000, 1010)), max_size=70)


@settings(max_examples=200, deadline=None)
@given(st.lists(lists, min_size=1, max_size=6))
def test_lines_come_back(lines):
    found = compression.decode_lines([compression.encode_line(np.array(x, dtype=np.int64)) for x in lines])
    assert [x.tolist() for x in found] == lines


def test_damaged_lines_do_not_touch_others():
    rng = np.random.default_rng(3)
    good = compression.encode_line(np.arange(100) * 7)
    for _ in range(300):
        line = np.clip(1000 + np.cumsum(rng.normal(0, 50, 60)), 0, 65535).astype(int)
        data = bytearray(compression.encode_line(line))
        data[int(rng.integers(len(data)))] ^= 1 << int(rng.integers(8))
        found = compression.decode_lines([bytes(data), good, bytes(data[: int(rng.integers(len(data)))]), None, b"\xff\xff\xff\xff"])
        assert found[1].tolist() == (np.arange(100) * 7).tolist()
        assert found[3] is None and found[4] is None


def test_smooth_lines_shrink():
    line = np.clip(1000 + np.cumsum(np.random.default_rng(0).normal(0, 5, 4096)), 0, 65535).astype(int)
    assert len(compression.encode_line(line)) < 0.35 * 2 * len(line)
    with pytest.raises(ValueError, match="16 bits"):
        compression.encode_line(np.array([70_000]))


def test_decompress_tells_codecs_apart(spark):
    rows = [(1, 0, b"\x00\x01\x01\x00"), (2, 1, compression.encode_line(np.array([5, 6, 7]))), (3, 9, b"xx"), (4, 0, b"odd"), (5, 1, None), (6, 0, b"")]
    found = compression.decompress(spark.createDataFrame(rows, "k long, codec int, payload binary"), ["k"])
    assert {r["k"]: r["dn"] for r in found.collect()} == {1: [1, 256], 2: [5, 6, 7], 3: None, 4: None, 5: None, 6: []}
