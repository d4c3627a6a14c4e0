"""SentencePiece encoding and decoding against the library."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.test_operators import corpus
from threadloom.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "th", " the", " ", "  ", "\n", "\t", "▁", "é", "日本", "́", "😀", "\x00", "ing", "<s>", "<0x41>", "1", ",.", "ß", "\r\n", "�", " " * 9, "\xa0", "aaaa", "abab"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def test_round_trip_equals_the_library(spark, library):
    docs = corpus(spark)
    found = Counter(tuple(r)[:4] for r in pieces.round_trip(docs, MODEL).collect())
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_eos=True)
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert found == want
    encoded = pieces.encode_texts(docs, MODEL)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((r.doc_id, tuple(library.encode(r.text or "", add_eos=True))) for r in docs.collect())
    decoded = pieces.decode_ids(encoded, MODEL)
    assert Counter(tuple(r) for r in decoded.collect()) == Counter((r.doc_id, library.decode(library.encode(r.text or ""))) for r in docs.collect())
    assert pieces.round_trip(corpus(spark, []), MODEL).count() == 0


def test_random_texts_and_ids_equal_the_library(library):
    model, rng = pieces.own_pieces(MODEL), random.Random(2)
    for _ in range(8_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        assert model.encode(text, True) == library.encode(text, add_eos=True), repr(text)
    for _ in range(5_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 8))]
        assert model.decode([str(i) for i in ids]) == library.decode(ids), ids


@pytest.mark.parametrize("text", ["x" * 20_000, "ab" * 10_000, "日" * 5_000, " " * 5_000, "aé" * 5_000, "▁a " * 3_000])
def test_long_texts_without_cuts(library, text):
    assert pieces.own_pieces(MODEL).encode(text, True) == library.encode(text, add_eos=True)


def test_small_stores_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    model = pieces.MergePieces(MODEL)
    text = "Words come, and words go, again and again. " * 5
    assert model.encode(text) == library.encode(text)


def test_other_kinds_of_models_are_refused(tmp_path):
    (tmp_path / "m").write_bytes(b"")
    with pytest.raises(ValueError):
        pieces.MergePieces(str(tmp_path / "m"))
