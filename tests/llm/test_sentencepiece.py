import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece as library
from helpers import by_id, clashing, documents
from hypothesis import given, settings, strategies as st

from pairloom.llm.sentencepiece import PieceModel, encode_documents, model_bytes

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "e", "th", "the", " ", "   ", "\n", "\t", "é", "ß", "▁", "中", "文", "😀", "\0", "ing", "<s>", "<0x0A>", "1", ".", "...", "____", "̀", "Ω", "я", "²"]


@pytest.fixture(scope="module")
def pair():
    return PieceModel(model_bytes(PATH)), library.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_mixed_parts(pair, text):
    model, other = pair
    assert model.encode(text) == other.encode(text)
    assert model.decode(model.encode(text)) == other.decode(other.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(pair, text):
    model, other = pair
    assert model.encode(text) == other.encode(text)


def test_any_ids_decode(pair):
    model, other = pair
    draw = random.Random(3)
    for _ in range(800):
        ids = [draw.randrange(32_000) if draw.random() < 0.5 else draw.randrange(259) for _ in range(draw.randint(0, 12))]
        assert model.decode(ids) == other.decode(ids), ids


def test_backtracking_reaches_the_merges(pair):
    model, _ = pair
    for word in ("ererererer", "aaaaaaaaaaaaaaa", "thththththing", "intheontionsh"):
        assert [model.texts[i] for i in model.encode_cut(word)] == model.merged(word)


def test_documents(spark, pair):
    _, other = pair
    texts = [(1, "The edatha, of\nwhich it."), (2, None), (3, ""), (4, " "), (5, "x" * 50_000), (6, "The edatha, of\nwhich it."), (7, "a b " * 20_000)]
    got = by_id(encode_documents(clashing(documents(spark, texts)).repartition(3), PATH))
    for doc_id, text in texts:
        ids = other.encode(text or "")
        assert got[doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(other.decode(ids).encode()).hexdigest())
    assert encode_documents(documents(spark, []), PATH).count() == 0


def test_texts_and_ids_are_there_on_request(spark):
    row = encode_documents(documents(spark, [(1, "on the")]), PATH, with_text=True).first()
    assert row["decoded"] == "on the" and len(row["ids"].split(",")) == row["n_tokens"]
