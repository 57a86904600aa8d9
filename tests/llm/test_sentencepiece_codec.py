import hashlib
import random

import pytest
import sentencepiece
from helpers import documents, invented

from siltstone.llm.queries import PIECES
from siltstone.llm.sentencepiece_codec import PieceCodec, decode_documents, encode_documents, token_digests


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def own():
    return PieceCodec(PIECES)


def test_random_texts_encode_and_decode_as_the_library_does(library, own):
    rnd = random.Random(9)
    parts = ["the", "Hello", " ", "  ", "\n", "\t", "中文", "привет", "😀", "é", "http://", "1234", "'s", "▁", "...", "ing", "\x00", "\xa0", "ﬁ", "é"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        ids = own.encode(text)
        assert ids == library.encode(text, add_eos=True), text
        assert own.decode(ids) == library.decode(ids), text


@pytest.mark.parametrize("word", ["", "the", "中", "😀"])
def test_runs_of_spaces(library, own, word):
    for count in range(0, 70):
        for text in (" " * count + word, "a" + " " * count + word, word + " " * count):
            assert own.encode(text) == library.encode(text, add_eos=True)


def test_ids_that_no_text_gives_decode_as_the_library_does(library, own):
    rnd = random.Random(2)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000), 2]) for _ in range(5)]
        assert own.decode(ids) == library.decode(ids)


def test_digests_per_row(spark, library):
    texts = [*invented(13, 30), None, "", "  lead", "tail  ", "very long text " * 30_000, "same", "same"]
    df = documents(spark, texts).withColumnsRenamed({"lang": "n_tokens"})
    df = df.unionByName(df.where("doc_id = 3"))
    rows = token_digests(df, PIECES, ["doc_id", "n_tokens", "source"]).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert token_digests(df.limit(0), PIECES, ["doc_id"]).collect() == []


def test_round_trip_of_columns(spark):
    texts = ["Some text.", None, "", "é  中\n"]
    rows = decode_documents(encode_documents(documents(spark, texts), PIECES), PIECES).collect()
    assert {r.doc_id: r.decoded for r in rows} == {i: t or "" for i, t in enumerate(texts)}
