"""Lossless compression of lines of counts: adaptive Rice codes.

A line is the differences of neighbouring counts, folded to whole numbers from
0, in blocks of 16. A block starts with its parameter k (5 bits); then come all
its quotients by 2**k in unary, then all remainders in k bits. Where that would
be longer, k is `RAW` and the values follow plainly. Decoding runs over all
lines of a batch at once: block by block, each line at its own bit.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Codec numbers of packets, values of a block, bits of a parameter, the parameter of plain values, bits of a plain value.
PLAIN, RICE = 0, 1
BLOCK, PARAMETER_BITS, RAW, RAW_BITS = 16, 5, 31, 18
MAX_K = 17
LIMIT = 1 << 16
#: Bytes that are decoded at once.
CHUNK = 1 << 19


def encode_line(counts: np.ndarray) -> bytes:
    """The number of counts (4 bytes), then their bits; counts are whole numbers from 0 to 65535."""
    counts = np.asarray(counts, dtype=np.int64)
    if len(counts) and (counts.min() < 0 or counts.max() >= LIMIT):
        raise ValueError("counts must fit 16 bits")
    step = np.diff(counts, prepend=0)
    folded = (step << 1) ^ (step >> 63)
    n_blocks = -(-len(folded) // BLOCK)
    value = np.zeros((n_blocks, BLOCK), dtype=np.int64)
    value.ravel()[: len(folded)] = folded
    held = np.full(n_blocks, BLOCK)
    if n_blocks:
        held[-1] = len(folded) - BLOCK * (n_blocks - 1)
    real = np.arange(BLOCK) < held[:, None]
    costs = np.stack([((value >> k) * real).sum(axis=1) + held * (1 + k) for k in range(MAX_K + 1)], axis=1)
    k = costs.argmin(axis=1)
    plain = costs[np.arange(n_blocks), k] > held * RAW_BITS
    length = PARAMETER_BITS + np.where(plain, held * RAW_BITS, costs[np.arange(n_blocks), k])
    start = np.cumsum(length) - length
    bits = np.zeros(int(length.sum()), dtype=np.uint8)

    def put(at: np.ndarray, number: np.ndarray, wide: np.ndarray) -> None:
        for i in range(int(wide.max(initial=0))):  # the highest bit first
            some = i < wide
            bits[at[some] + i] = number[some] >> (wide[some] - 1 - i) & 1

    put(start, np.where(plain, RAW, k), np.full(n_blocks, PARAMETER_BITS))
    block, place = np.nonzero(real)
    own = value[block, place]
    coded = ~plain[block]
    quotient = np.where(coded, own >> k[block], 0)
    through = np.cumsum(quotient + coded)
    first = np.concatenate([[0], through])[np.cumsum(held) - held][block]  # what earlier blocks used
    body = start[block] + PARAMETER_BITS
    bits[(body + through - first - 1)[coded]] = 1
    ones_end = body + np.bincount(block, weights=(quotient + coded), minlength=n_blocks).astype(np.int64)[block]
    wide = np.where(coded, k[block], RAW_BITS)
    put(np.where(coded, ones_end, body) + place * wide, np.where(coded, own & ((1 << k[block]) - 1), own), wide)
    return struct.pack(">I", len(counts)) + np.packbits(bits).tobytes()


def decode_lines(payloads: Sequence[bytes | None]) -> list[np.ndarray | None]:
    """The counts of each payload; None for a payload that is null or is no such line."""
    out: list[np.ndarray | None] = [None] * len(payloads)
    now, held = [], 0
    for i, payload in enumerate(payloads):
        if payload is None or len(payload) < 4:
            continue
        now.append(i)
        held += len(payload)
        if held >= CHUNK:
            _decode_some(now, payloads, out)
            now, held = [], 0
    if now:
        _decode_some(now, payloads, out)
    return out


def _decode_some(rows: list[int], payloads: Sequence[bytes | None], out: list) -> None:
    sizes = np.array([len(payloads[i]) for i in rows], dtype=np.int64)
    data = np.frombuffer(b"".join(payloads[i] for i in rows) + bytes(8), dtype=np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    counts = np.array([struct.unpack_from(">I", payloads[i])[0] for i in rows], dtype=np.int64)
    stop = ends * 8
    at = (starts + 4) * 8
    good = counts <= (stop - at)  # every count takes a bit at least
    counts = np.where(good, counts, 0)
    bits = np.unpackbits(data)
    ones = np.flatnonzero(bits)
    rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])  # ones before each bit
    ones = np.concatenate([ones, np.full(BLOCK, len(bits))])
    first = np.cumsum(counts) - counts
    folded = np.zeros(int(counts.sum()), dtype=np.int64)
    wide_data = data.astype(np.uint64)

    def take(place: np.ndarray, wide: np.ndarray) -> np.ndarray:
        """Numbers of `wide` bits (25 at most) at these bits."""
        byte = np.minimum(place >> 3, len(data) - 4)
        word = (wide_data[byte] << np.uint64(24)) | (wide_data[byte + 1] << np.uint64(16)) | (wide_data[byte + 2] << np.uint64(8)) | wide_data[byte + 3]
        return (word.astype(np.int64) >> (32 - (place & 7) - wide)) & ((1 << wide) - 1)

    done = np.zeros(len(rows), dtype=np.int64)
    while True:
        live = np.flatnonzero(good & (done < counts))
        if not len(live):
            break
        here = np.minimum(BLOCK, counts[live] - done[live])
        good[live[at[live] + PARAMETER_BITS > stop[live]]] = False
        k = take(at[live], np.full(len(live), PARAMETER_BITS))
        plain = k == RAW
        good[live[~plain & (k > MAX_K)]] = False
        k = np.where(plain, RAW_BITS, np.minimum(k, MAX_K))
        body = at[live] + PARAMETER_BITS
        j = np.arange(BLOCK)
        real = j < here[:, None]
        until = ones[np.minimum(rank[np.minimum(body, len(bits))][:, None] + j, len(ones) - 1)]  # the one that ends each quotient
        quotient = np.diff(until, axis=1, prepend=(body - 1)[:, None]) - 1
        after = np.where(plain, body, until[np.arange(len(live)), here - 1] + 1)
        low = take(after[:, None] + j * k[:, None], np.broadcast_to(k[:, None], real.shape))
        number = np.where(plain[:, None], low, (quotient << k[:, None]) | low)
        following = after + here * k
        good[live[following > stop[live]]] = False
        block, place = np.nonzero(real)
        folded[(first[live] + done[live])[block] + place] = number[block, place]
        at[live] = np.minimum(following, stop[live])
        done[live] += here
    step = (folded >> 1) ^ -(folded & 1)
    total = np.cumsum(step)
    for n, i in enumerate(rows):
        if not good[n]:
            continue
        own = total[first[n] : first[n] + counts[n]] - (total[first[n] - 1] if first[n] else 0)
        if not len(own) or (own.min() >= 0 and own.max() < LIMIT):
            out[i] = own.astype(np.int32)


def _plain(payload: bytes | None) -> np.ndarray | None:
    return None if payload is None or len(payload) % 2 else np.frombuffer(payload, ">u2").astype(np.int32)


def decompress(packets: DataFrame, keep: list[str], *, name: str = "dn") -> DataFrame:
    """The columns `keep` and the counts of each packet (codec, payload), as array<int>.

    Null where the payload is null, does not decode, or the codec is not known
    (0: 16-bit counts, big-endian; 1: Rice codes).
    """

    def run(batches):
        for batch in batches:
            codec, payload = batch.column("codec").to_pylist(), batch.column("payload").to_pylist()
            lines = decode_lines([p if c == RICE else None for c, p in zip(codec, payload, strict=True)])
            lines = [_plain(p) if c == PLAIN else x for c, p, x in zip(codec, payload, lines, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lines, pa.list_(pa.int32()))], [*keep, name])

    kinds = ", ".join(f"`{c}` {packets.schema[c].dataType.simpleString()}" for c in keep)
    return packets.mapInArrow(run, f"{kinds}, `{name}` array<int>")


def compress(lines: DataFrame, keep: list[str], *, name: str = "dn") -> DataFrame:
    """The columns `keep` and each line's counts as a Rice-coded `payload` (null for a null line)."""

    def run(batches):
        for batch in batches:
            made = [None if x is None else encode_line(np.array(x)) for x in batch.column(name).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.binary())], [*keep, "payload"])

    kinds = ", ".join(f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in keep)
    return lines.mapInArrow(run, f"{kinds}, payload binary")
