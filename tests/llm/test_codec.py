import time

import numpy as np
import pytest
import sentencepiece
from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from rasterloom.llm import sentencepiece_codec as codec

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=codec.DEFAULT_MODEL)
OWN = codec.Codec(codec.Pieces.load(codec.DEFAULT_MODEL))


def encode(own, text):
    ids, ends = own.encode([text])
    return ids.tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aeinrst .,▁\n", max_size=80) | st.text("ab ", max_size=40))
def test_byte_pair_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encode(OWN, text) == LIBRARY.encode(text)
    if codec.BLANK not in text:
        assert OWN.decode(encode(OWN, text)) == text


def test_smallest_table(small):
    rows = codec.decode(codec.encode(small, keep_text=True)).collect()
    assert all(r["ids"] == LIBRARY.encode(r["text"]) and r["decoded"] == r["text"] for r in rows) and len(rows) == small.count()


def best_path(pieces, scores, word, unknown):
    """Plain dynamic programme: the highest sum of scores."""
    best = [0.0] + [-np.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            value = scores.get(word[i:j], unknown if j - i == 1 else None)
            if value is not None:
                best[j] = max(best[j], best[i] + value)
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text("ab▁", min_size=1, max_size=4).filter(lambda t: codec.BLANK not in t.lstrip(codec.BLANK)), st.floats(-9, -1, width=16), min_size=3, max_size=12), st.text("abc ", max_size=14))
def test_unigram_score_is_the_best(scores, text):
    pieces = codec.Pieces(["<unk>", *scores], np.array([0, *scores.values()], np.float32), [codec.UNKNOWN, *[codec.NORMAL] * len(scores)], codec.UNIGRAM)
    own = codec.Codec(pieces)
    unknown = min(scores.values()) - codec.UNKNOWN_PENALTY
    got = sum(own.score[own.unknown] if i == 0 else pieces.score[i] for i in encode(own, text))
    want = best_path(pieces, scores, codec.BLANK + text.replace(" ", codec.BLANK), unknown) if text else 0
    assert got == pytest.approx(want, rel=1e-4)


def test_awkward_rows(docs_of):
    rows = codec.decode(codec.encode(docs_of(AWKWARD), keep_text=True)).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert r["ids"] == (LIBRARY.encode(r["text"]) if r["text"] else [])
        assert r["decoded"] == (r["text"] or "").replace(codec.BLANK, " ")
    assert codec.encode(docs_of([])).count() == 0


def test_long_word_without_blanks():
    text = "supercalifragilistic" * 300
    assert encode(OWN, text) == LIBRARY.encode(text)


def test_a_model_with_other_normalisation_is_refused(tmp_path):
    path = tmp_path / "m.model"
    for rules in (b"\x12\x01x", b"\x20\x01", b"\x20\x00\x28\x00"):  # a character map, extra blanks removed, blanks not marked
        path.write_bytes(b"\x1a" + bytes([len(rules)]) + rules)
        with pytest.raises(ValueError, match="leave characters"):
            codec.Pieces.load(str(path))


@pytest.mark.parametrize("kind", ["latin", "cjk", "digits", "mixed"])
def test_long_words_are_cut_like_short_ones(kind, monkeypatch):
    letters = {"latin": "aeinrstlo", "cjk": "的一是不了人我在有他这为之大来以个中上们", "digits": "0123456789+/", "mixed": "ab的1\U0001f600é☃z"}[kind]
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list(letters), n)) for n in (400, 401, 900)]
    monkeypatch.setattr(codec, "ENDS", 97)
    assert [OWN.long_word(w) for w in words] == [OWN.viterbi([w])[0] for w in words]
    for w in words:
        assert encode(OWN, w) == LIBRARY.encode(w)


@pytest.mark.parametrize("letters", ["aeinrstlo", "0123456789", "的一是不了人我在有他这为之大来以个中上们"])
def test_a_million_unbroken_bytes_take_seconds(letters):
    word = "".join(np.random.default_rng(1).choice(list(letters), 1_000_000 // len(letters[0].encode())))
    own = codec.Codec(codec.Pieces.load(codec.DEFAULT_MODEL))
    began = time.perf_counter()
    ids = encode(own, word)
    assert time.perf_counter() - began < 60
    assert own.decode(ids) == word
