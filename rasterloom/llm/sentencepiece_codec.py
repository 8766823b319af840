"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut where no piece of the vocabulary can cross: before runs of
blanks, and, if the vocabulary allows, where letters begin or end. Distinct
words of equal length advance together, one character a step:
hashes of the substrings that end there probe the sorted piece hashes, and the
best predecessor of each word is kept as a backpointer.

For a unigram model the best path has the highest sum of scores. For a
byte-pair model (whose ids come from merge order, not from scores) a path is
allowed only if merging the text of each two neighbouring pieces gives these
two pieces again; exactly the merge result meets that, so the same search
finds the ids that the merges would give. Characters outside the vocabulary
become byte pieces.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, slices

BLANK = "▁"
LETTER, OTHER = r"[^\W\d_]", rf"(?:[^\w{BLANK}]|[\d_])"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
#: Added to the least score for a character outside a unigram vocabulary.
UNKNOWN_PENALTY = 10.0
#: Words of so many characters are cut one by one; ends whose pieces are probed at once.
LONG, ENDS = 400, 8192
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Pieces:
    """A vocabulary as plain arrays, small enough to broadcast (its size is the model file's)."""

    text: list[str]
    score: np.ndarray
    kind: list[int]
    model_type: int
    add_blank: bool = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        text, score, kind, model_type, add_blank = [], [], [], UNIGRAM, True
        for number, value in _fields(Path(path).read_bytes()):
            if number == 1:
                piece = dict(_fields(value))
                text.append(piece[1].decode())
                score.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                kind.append(piece.get(3, NORMAL))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))  # 2: character map, 3: blank in front, 4: extra blanks go, 5: blanks are marked
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only models that leave characters and blanks as they are are supported")
                add_blank = bool(rules.get(3, 1))
        if model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")
        return cls(text, np.array(score, np.float32), kind, model_type, add_blank)


def _hash(codes: np.ndarray) -> np.ndarray:
    """Running hashes of each row's prefixes, (n, length + 1)."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * MULTIPLIER + codes[:, j] + np.uint64(1)
    return out


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64)


@dataclass
class Codec:
    """Encoder and decoder of one worker; remembers the words and piece pairs it has seen, up to a bound."""

    pieces: Pieces
    remember: int = 120_000
    _words: dict[str, bytes] = field(default_factory=dict)  # ids as bytes of int32
    _pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self):
        self.id_of = {t: i for i, (t, k) in enumerate(zip(self.pieces.text, self.pieces.kind, strict=True)) if k in (NORMAL, USER_DEFINED)}
        self.byte_id = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.pieces.text, self.pieces.kind, strict=True)) if k == BYTE}
        self.unknown_id = next((i for i, k in enumerate(self.pieces.kind) if k == UNKNOWN), 0)
        self.longest = max(map(len, self.id_of), default=1)
        ids = np.array(list(self.id_of.values()), dtype=np.int64)
        hashes = np.array([_hash(_codes([t]))[0, -1] for t in self.id_of], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        if len(np.unique(self.hashes)) < len(self.hashes):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 22, dtype=bool)  # which values the top bits of a piece's hash take: most probes end here
        self.maybe[self.hashes >> np.uint64(42)] = True
        self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, MULTIPLIER)]))
        size = len(self.pieces.text)
        known = self.pieces.score[ids] if len(ids) else np.zeros(1, np.float32)
        self.score = np.append(self.pieces.score, np.float32(known.min() - np.float32(UNKNOWN_PENALTY)))  # at `size`: unknown
        self.unknown = size
        self.pair_key = np.full(1 << 20, -1, dtype=np.int64)  # direct-mapped front of _pairs
        self.pair_ok = np.zeros(1 << 20, dtype=bool)
        self.words = self._cutter()
        self.raw = [t.replace(BLANK, " ").encode() for t in self.pieces.text]
        for byte, i in self.byte_id.items():
            self.raw[i] = bytes([byte])
        for i, k in enumerate(self.pieces.kind):
            if k in (CONTROL, UNUSED):
                self.raw[i] = b""

    def _cutter(self) -> re.Pattern:
        """Matches the stretches of a text between which no piece of the vocabulary reaches."""
        letter = re.compile(LETTER)
        ends, joins = False, set()  # a letter then another character in one piece; characters that come before a letter
        for text in self.id_of:
            for a, b in zip(text, text[1:], strict=False):
                if b == BLANK and a != BLANK:
                    raise ValueError(f"piece {text!r} has a blank inside")
                if letter.match(a) and not letter.match(b):
                    ends = True
                elif not letter.match(a) and letter.match(b):
                    joins.add(a)
        if ends:
            return re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        before = "".join(map(re.escape, sorted(joins - {BLANK})))
        tail = f"(?:(?<=[{before}]){LETTER}+)?" if before else ""
        return re.compile(f"{BLANK}*{OTHER}+{tail}|{BLANK}*{LETTER}+|{BLANK}+")

    def merges(self, text: str) -> list[int]:
        """Byte-pair merges of a short string, done literally: best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, where = -np.inf, -1
            for i in range(len(parts) - 1):
                found = self.id_of.get(parts[i] + parts[i + 1])
                if found is not None and self.pieces.score[found] > best:
                    best, where = self.pieces.score[found], i
            if where < 0:
                return [self.id_of.get(p, self.unknown) for p in parts]
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def _may_follow(self, key: int) -> bool:
        a, b = key // (self.unknown + 2) - 1, key % (self.unknown + 2)
        if b == self.unknown:
            return True
        if a in (-1, self.unknown):
            return self.merges(self.pieces.text[b]) == [b]
        return self.merges(self.pieces.text[a] + self.pieces.text[b]) == [a, b]

    def _allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the piece `right` may come after `left` (-1: nothing before) in a byte-pair result."""
        key = (left + 1) * (self.unknown + 2) + right
        slot = (key.astype(np.uint64) * MULTIPLIER >> np.uint64(44)).astype(np.int64)
        ok = self.pair_ok[slot]
        new = np.flatnonzero(self.pair_key[slot] != key)
        if len(new):
            keys, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            if len(self._pairs) > 5 * self.remember:
                self._pairs.clear()
            fresh = np.array([self._pairs[k] if k in self._pairs else self._pairs.setdefault(k, self._may_follow(k)) for k in keys.tolist()], dtype=bool)
            ok[new] = fresh[back]
            self.pair_key[slot[new[first]]], self.pair_ok[slot[new[first]]] = keys, fresh
        return ok

    def viterbi(self, words: list[str]) -> list[bytes]:
        """Piece ids (bytes of int32) of words that all have the same length."""
        n, length = len(words), len(words[0])
        prefix = _hash(_codes(words))
        best = np.full((n, length + 1), -np.inf, dtype=np.float32)
        best[:, 0] = 0
        last = np.full((n, length + 1), -1, dtype=np.int64)
        came = np.zeros((n, length + 1), dtype=np.int64)
        every = np.arange(n)
        for j in range(1, length + 1):
            low = max(0, j - self.longest)
            parts = prefix[:, j, None] - prefix[:, low:j] * self.powers[j - low : 0 : -1]
            row, column = np.nonzero(self.maybe[parts >> np.uint64(42)])
            probe = parts[row, column]
            at = np.minimum(np.searchsorted(self.hashes, probe), len(self.hashes) - 1)
            hit = self.hashes[at] == probe
            row, column, piece = row[hit], column[hit], self.ids[at[hit]]
            # a single character outside the vocabulary is an unknown piece
            alone = np.ones(n, dtype=bool)
            alone[row[column == j - 1 - low]] = False
            row, column = np.concatenate([row, every[alone]]), np.concatenate([column, np.full(alone.sum(), j - 1 - low)])
            piece = np.concatenate([piece, np.full(alone.sum(), self.unknown)])
            if self.pieces.model_type == BPE:
                ok = self._allowed(last[row, low + column], piece)
                row, column, piece = row[ok], column[ok], piece[ok]
            total = np.full(parts.shape, -np.inf, dtype=np.float32)
            total[row, column] = best[row, low + column] + self.score[piece]
            ids = np.full(parts.shape, -1, dtype=np.int64)
            ids[row, column] = piece
            pick = total.argmax(axis=1)
            best[:, j], last[:, j], came[:, j] = total[every, pick], ids[every, pick], low + pick
        if (best[:, length] == -np.inf).any():
            raise ValueError(f"no segmentation of {words[int(best[:, length].argmin())][:40]!r}")
        steps, at = [], np.full(n, length)
        while (at > 0).any():
            steps.append(np.where(at > 0, last[every, at], -1))
            at = np.where(at > 0, came[every, at], 0)
        path = np.array(steps[::-1]).T
        kept = path >= 0
        flat, ends = path[kept].astype("<i4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for i in np.flatnonzero((path == self.unknown).any(axis=1)).tolist():
            out[i] = self._spell_unknown(words[i], path[i][kept[i]].tolist())
        return out

    def _hits(self, prefix: np.ndarray, start: int, stop: int) -> tuple[list[int], list[int], list[int]]:
        """Ends in (start, stop], lengths and ids of all pieces that end there, by end, the longest first; an end without a piece of one character has an unknown one."""
        ends, sizes, pieces = [], [], []
        alone = np.zeros(stop - start, dtype=bool)
        for size in range(min(self.longest, stop), 0, -1):
            j = np.arange(max(start + 1, size), stop + 1)
            parts = prefix[j] - prefix[j - size] * self.powers[size]
            some = np.flatnonzero(self.maybe[parts >> np.uint64(42)])
            at = np.minimum(np.searchsorted(self.hashes, parts[some]), len(self.hashes) - 1)
            hit = self.hashes[at] == parts[some]
            found = j[some[hit]]
            ends.append(found)
            sizes.append(np.full(len(found), size))
            pieces.append(self.ids[at[hit]])
            if size == 1:
                alone[found - start - 1] = True
        lonely = np.flatnonzero(~alone) + start + 1
        end, size, piece = np.concatenate([*ends, lonely]), np.concatenate([*sizes, np.ones(len(lonely), np.int64)]), np.concatenate([*pieces, np.full(len(lonely), self.unknown)])
        order = np.lexsort((-size, end))
        return end[order].tolist(), size[order].tolist(), piece[order].tolist()

    def long_word(self, word: str) -> bytes:
        """As `viterbi`, for one long word: pieces are probed for many ends at once, and what is left for each end is its few pieces."""
        length = len(word)
        prefix = _hash(_codes([word]))[0]
        best, last, came = array("f", [-np.inf]) * (length + 1), array("q", [-1]) * (length + 1), array("q", [0]) * (length + 1)
        best[0] = 0.0
        score, pairs, ordered, base = self.score.tolist(), self._pairs, self.pieces.model_type == BPE, self.unknown + 2
        total = array("f", [0.0])  # rounds to single precision
        for start in range(0, length, ENDS):
            for end, size, piece in zip(*self._hits(prefix, start, min(length, start + ENDS)), strict=True):
                before = end - size
                total[0] = best[before] + score[piece]
                if total[0] <= best[end]:
                    continue
                if ordered:
                    key = (last[before] + 1) * base + piece
                    ok = pairs.get(key)
                    if ok is None:
                        if len(pairs) > 5 * self.remember:
                            pairs.clear()
                        ok = pairs[key] = self._may_follow(key)
                    if not ok:
                        continue
                best[end], last[end], came[end] = total[0], piece, before
        if best[length] == -np.inf:
            raise ValueError(f"no segmentation of {word[:40]!r}")
        path, at = [], length
        while at:
            path.append(last[at])
            at = came[at]
        path.reverse()
        return self._spell_unknown(word, path) if self.unknown in path else np.array(path, dtype="<i4").tobytes()

    def _spell_unknown(self, word: str, ids: list[int]) -> bytes:
        """Replace unknown pieces, one character each, by byte pieces."""
        out, at = [], 0
        for i in ids:
            if i == self.unknown:
                spelled = [self.byte_id.get(b) for b in word[at].encode("utf-8", "surrogatepass")]
                out += spelled if None not in spelled else [self.unknown_id]
                at += 1
            else:
                out.append(i)
                at += len(self.pieces.text[i])
        return np.array(out, dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin and end."""
        start = BLANK if self.pieces.add_blank else ""
        cut_up = [self.words.findall(start + t.replace(" ", BLANK)) if t else [] for t in texts]
        known = self._words
        here = set(chain.from_iterable(cut_up))
        if len(known) > self.remember:
            known = self._words = {w: known[w] for w in here if w in known}
        by_length: dict[int, list[str]] = {}
        for word in here.difference(known):
            by_length.setdefault(len(word), []).append(word)
        for length, words in by_length.items():
            if length >= LONG:
                known.update((w, self.long_word(w)) for w in words)
                continue
            step = max(1, 80_000 // (length + 1))
            for i in range(0, len(words), step):
                known.update(zip(words[i : i + step], self.viterbi(words[i : i + step]), strict=True))
        found = [b"".join(map(known.__getitem__, words)) for words in cut_up]
        ends = np.cumsum([0, *map(len, found)]) // 4
        return np.frombuffer(b"".join(found), "<i4"), ends.astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.pieces.add_blank and text.startswith(" ") else text

    def decode_all(self, lists: pa.ListArray) -> list[str]:
        """Texts of all lists of ids; a null list gives an empty text."""
        flat = lists.flatten().to_numpy().tolist()
        ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
        return [self.decode(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker process and broadcast, so its memory outlives a task."""
    if shared.value is not None and id(shared.value) not in _codecs:
        _codecs.clear()
        _codecs[id(shared.value)] = Codec(shared.value)
    return _codecs[id(shared.value)]


def encode(docs: DataFrame, *, model_path: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, check: bool = False) -> DataFrame:
    """id, `ids` array<int>; one row per input row. `keep_text` adds the text, `check` whether the ids decode to it (`round_trip`).

    Null and empty texts have no pieces. A literal U+2581 counts as a blank,
    as in the model's own normalisation. Columns besides id and text are not
    read; repeated rows are encoded each for itself, and an empty table gives
    no rows. A long text is one row's work: its words are cut and encoded
    together.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        codec = _codec(shared)
        for part in slices(batches, limit=2 << 20):
            ids, ends = codec.encode([x or "" for x in part.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            columns = {"id": part.column("id"), "ids": lists}
            if keep_text:
                columns["text"] = part.column("text")
            if check:
                back = codec.decode_all(lists)
                columns["round_trip"] = pa.array([a == (b.as_py() or "") for a, b in zip(back, part.column("text"), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>" + ", text string" * keep_text + ", round_trip boolean" * check
    found = arrow_map(rows, run, schema)
    return found.select(F.col("id").alias(id_col), *([F.col("text").alias(text_col)] if keep_text else []), "ids", *(["round_trip"] if check else []))


def decode(encoded: DataFrame, *, model_path: str = DEFAULT_MODEL, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns plus the text of `ids_col`; null ids give an empty text, ids outside the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces.load(model_path))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(encoded.schema))
    where = encoded.columns.index(ids_col)

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = codec.decode_all(part.column(where))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*(f"c{i}" for i in range(part.num_columns)), "decoded"])

    renamed = encoded.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(encoded.columns)])
    found = arrow_map(renamed, run, f"{schema}, decoded string")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(encoded.columns)], F.col("decoded").alias(into))
