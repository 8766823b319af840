"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters acts as one blank, and
the 1- to 3-grams of what is left are hashed into a fixed number of buckets.
Training sums bucket counts per language with an ordinary Spark aggregation;
the log-probability matrix (languages x buckets) is broadcast, in blocks of
some languages if there are many, and each Arrow batch is scored with one
gather and one segmented sum. Long texts are scored in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, cut, slices

UNDETERMINED = "und"
#: Languages that are scored, or whose counts are fetched, together: 16 MB of log-probabilities at 16 bits.
BLOCK = 64
#: Distinct (language, bucket) pairs that a training task adds up before it passes them on.
HELD = 4 << 20
#: Bytes of text scored at once; the arrays over its n-grams take some 200 times as much.
CHUNK = 1 << 18


@cache
def _fold_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other characters."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters with one blank (0) after each run of them, their document numbers, and whether each document has a letter."""
    points = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    folded = _fold_table()[points]
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[: len(points)]
    letter = folded > 0
    has_letter = np.zeros(len(texts), dtype=bool)
    has_letter[owner[letter]] = True
    keep = letter.copy()  # one blank after each run of letters
    keep[1:] |= letter[:-1]
    return folded[keep], owner[keep], has_letter


def _gram_parts(texts: list[str], bits: int, context: int = 0) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each length of n-grams their buckets and document numbers, in document order, without those that end in the first `context` characters; and whether each document has a letter."""
    codes, docs, has_letter = _folded(texts)
    codes, docs = codes.astype(np.uint64), docs.astype(np.int32)
    parts = []
    hashed = np.zeros(len(codes), dtype=np.uint64)
    for n in (1, 2, 3):
        if len(codes) < n:
            break
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x110001) + codes[n - 1 :] + np.uint64(1)
        inside = docs[: len(hashed)] == docs[n - 1 :]
        inside[: max(0, context - n + 1)] = False
        mixed = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        parts.append((mixed[inside].astype(np.int32), docs[: len(hashed)][inside]))
    return parts, has_letter


def _grams(texts: list[str], bits: int, context: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with all lengths in one."""
    parts, has_letter = _gram_parts(texts, bits, context)
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *(x for x, _ in parts)]), np.concatenate([none, *(x for _, x in parts)]), has_letter


def _pieces(text: str) -> Iterator[tuple[str, int]]:
    """A text in pieces of CHUNK characters: (what to fold, how many folded characters of it only give context)."""
    carry = ""
    for at in range(0, len(text), CHUNK):
        piece = carry + text[at : at + CHUNK]
        yield piece, len(carry)
        codes = _folded([piece])[0]
        carry = "".join(chr(c) if c else " " for c in (codes[-2:] if codes[-2:][:1].any() else codes[-3:]).tolist())


def _evidence(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets, document numbers (in order), and documents with a letter, of all texts: short ones together by length of n-gram, long ones piece by piece."""
    short = [i for i, x in enumerate(texts) if len(x) <= CHUNK]
    if short:
        parts, letter = _gram_parts([texts[i] for i in short], bits)
        place = np.array(short)
        for buckets, owners in parts:
            yield buckets, place[owners], place[letter]
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            for piece, context in _pieces(text):
                parts, letter = _gram_parts([piece], bits, context)
                for buckets, owners in parts:
                    yield buckets, owners + i, np.full(int(letter.any()), i)


def train(
    docs: DataFrame, *, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
    bits: int = 16, max_docs_per_language: int = 4000, alpha: float = 0.5,
) -> tuple[list[str], np.ndarray]:
    """Languages and their (languages x 2**bits + prior) log-probability matrix.

    A language with more than `max_docs_per_language` labelled rows is learned
    from about that many of them, picked by a hash of the id; class priors
    count all rows. Rows with a null text or label teach nothing; an empty
    table gives no languages. There may be any number of languages; each
    takes a row of the matrix (256 KB at 16 bits) in the driver.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")
    )
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, (1 << bits) + 1), dtype=np.float32)
    facts = docs.sparkSession.createDataFrame(
        [(x, i, min(1.0, max_docs_per_language / counts[x])) for i, x in enumerate(languages)], "label string, number int, share double"
    )
    sample = rows.join(F.broadcast(facts), "label").where(F.pmod(F.xxhash64(F.lit("language-sample"), "id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def count(batches):
        held, size = [], 0

        def total():
            codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([n for _, n in held]), len(codes)).astype(np.int64)

        def passed(codes, n):
            for at in range(0, len(codes), 1 << 20):
                part = codes[at : at + (1 << 20)]
                yield pa.RecordBatch.from_arrays([pa.array(part >> bits, pa.int32()), pa.array(part & ((1 << bits) - 1), pa.int32()), pa.array(n[at : at + (1 << 20)])], ["label", "bucket", "n"])

        for part in slices(batches, limit=CHUNK):
            labels = part.column("number").to_numpy().astype(np.int64)
            for buckets, owners, _ in _evidence(part.column("text").to_pylist(), bits):
                codes, n = np.unique((labels[owners] << bits) + buckets, return_counts=True)
                held.append((codes, n))
                size += len(codes)
            if size > HELD:
                held = [total()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from passed(*held[0])
                    held, size = [], 0
        if held:
            yield from passed(*total())

    summed = arrow_map(sample.select("text", "number"), count, "label int, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    if len(languages) > BLOCK:
        summed = cut(summed)
    matrix = np.empty((len(languages), (1 << bits) + 1), dtype=np.float32)
    for first in range(0, len(languages), BLOCK):
        some = summed.where((F.col("label") >= first) & (F.col("label") < first + BLOCK)).toArrow()
        total = np.full((len(languages[first : first + BLOCK]), 1 << bits), alpha)
        total[some.column("label").to_numpy() - first, some.column("bucket").to_numpy()] += some.column("n").to_numpy()
        matrix[first : first + BLOCK, :-1] = np.log(total / total.sum(axis=1, keepdims=True))
    matrix[:, -1] = np.log([counts[x] / sum(counts.values()) for x in languages])
    return languages, matrix


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: id (and the columns of `keep`), `lang_pred`, `score`.

    `score` is the posterior of the language named. A text that is null or
    has no letter, and every text under a model without languages, is `und`
    with score 0. Ties go to the language that sorts first. An empty table
    gives no rows; rows that repeat are predicted each for itself.
    """
    languages, matrix = model
    bits = int(matrix.shape[1] - 1).bit_length() - 1
    carried = [id_col, *(keep or [])]
    names = [f"c{i}" for i in range(len(carried))]
    out = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, names, strict=True)], F.col(text_col).alias("text"))
    # what the languages so far say: the best of them, its log-probability, and the sum of all relative to it
    out = out.withColumns({"lang_pred": F.lit(UNDETERMINED), "top": F.lit(float("-inf")), "mass": F.lit(0.0)})
    kinds = ", ".join(f"{n} {out.schema[n].dataType.simpleString()}" for n in [*names, "text"])

    def step(some: list[str], shared):
        def score(batches):
            table = shared.value
            for part in slices(batches, limit=CHUNK):
                texts = [x or "" for x in part.column("text").to_pylist()]
                total = np.zeros((len(texts), len(some))) + table[-1]
                known = np.zeros(len(texts), dtype=bool)
                for buckets, owners, letter in _evidence(texts, bits):
                    known[letter] = True
                    starts = np.flatnonzero(np.diff(owners, prepend=-1))
                    if len(starts):
                        total[owners[starts]] += np.add.reduceat(table[buckets], starts, axis=0, dtype=np.float64)
                here, best = total.max(axis=1), total.argmax(axis=1)
                before = part.column("top").to_numpy()
                top = np.maximum(before, here)
                mass = part.column("mass").to_numpy() * np.exp(before - top) + np.exp(total - top[:, None]).sum(axis=1)
                names_now = [some[b] if k and now > was else old for b, k, now, was, old in zip(best.tolist(), known.tolist(), here.tolist(), before.tolist(), part.column("lang_pred").to_pylist(), strict=True)]
                changed = {"lang_pred": pa.array(names_now, pa.string()), "top": pa.array(top), "mass": pa.array(mass)}
                yield pa.RecordBatch.from_arrays([changed.get(c, part.column(c)) for c in part.schema.names], part.schema.names)

        return score

    for first in range(0, len(languages), BLOCK):
        shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix[first : first + BLOCK].T))
        out = arrow_map(out, step(languages[first : first + BLOCK], shared), f"{kinds}, lang_pred string, top double, mass double")
    score = F.when(F.col("lang_pred") == UNDETERMINED, F.lit(0.0)).otherwise(1 / F.col("mass"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(carried, names, strict=True)], "lang_pred", score.alias("score"))


def held_out(id_col: str = "doc_id"):
    """True for the fifth of all rows that training never sees."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then predict every row.

    Returns id, `held_out`, `lang_pred`, `score`; see `train` and `predict`
    for nulls, ties, long texts and empty tables. Other input columns are not
    read.
    """
    model = train(docs.where(~held_out(id_col)), text_col=text_col, label_col=label_col, id_col=id_col, **options)
    found = predict(docs, model, text_col=text_col, id_col=id_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
