import numpy as np
from helpers import documents, invented
from pyspark.sql import functions as F

from siltstone.llm import language_hd as hd

LETTERS = {"aa": "abcdefgh", "bb": "ijklmnopq", "éé": "éèàùôßü"}


def texts_of(lang, seed, count=30):
    table = str.maketrans("abcdeéß", LETTERS[lang][:7])
    return [t.translate(table) for t in invented(seed, count, words=(5, 30), vocabulary=60)]


def plain_profile(text):
    """The bundle of a text, letter by letter."""
    letters = [ord(c.lower()) if c.isalpha() else 0 for c in text or ""]
    run = [0]
    for x in [*letters, 0]:
        if x or run[-1]:
            run.append(x)
    total = np.zeros(hd.DIMENSIONS)
    for a, b, c in zip(run, run[1:], run[2:]):
        if b:
            va, vb, vc = hd.letter_vectors(np.array([a, b, c]), hd.DIMENSIONS)
            total += np.roll(va, 2).astype(int) * np.roll(vb, 1) * vc
    return total


def test_profiles_match_letter_by_letter(spark):
    import pyarrow as pa

    texts = ["The  cat, the CAT!", None, "", "12 3.", "é", "Straße 𝒜b 中文", "x", "..." * 20 + "a" + "-" * 40 + "bcd", *texts_of("aa", 3, 5)]
    found, seen = hd.profiles(pa.array(texts, pa.string()), hd.Binder(hd.DIMENSIONS))
    for text, vector, letter in zip(texts, found, seen):
        assert np.array_equal(vector, plain_profile(text)), text
        assert letter == any(c.isalpha() for c in text or "")
    old, hd.PIECE = hd.PIECE, 16
    try:
        pieces, _ = hd.profiles(pa.array(texts, pa.string()), hd.Binder(hd.DIMENSIONS))
    finally:
        hd.PIECE = old
    # A text that is cut into pieces has the same profile.
    assert np.array_equal(pieces, found)


def test_held_out_languages_are_found(spark):
    texts, langs = [], []
    for seed, lang in enumerate(LETTERS):
        texts += texts_of(lang, seed)
        langs += [lang] * 30
    texts += [None, "", "123 !", "word " * 100_000]
    langs += [None, "aa", "bb", None]
    df = documents(spark, texts, langs).withColumn("score", F.lit("old"))
    prototypes = hd.fit_prototypes(df.where("doc_id % 3 <> 0"))
    assert list(prototypes) == sorted(LETTERS)
    rows = hd.predict(df, prototypes, ["doc_id", "lang", "score"]).collect()
    assert len(rows) == len(texts)
    known = [r for r in rows if r.doc_id < 90]
    assert sum(r.lang_pred == r.lang for r in known if texts[r.doc_id].strip()) >= 0.97 * len(known)
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    again = hd.fit_prototypes(df.where("doc_id % 3 <> 0").repartition(7))
    assert all(np.array_equal(again[k], prototypes[k]) for k in prototypes)


def test_no_training_rows_and_no_rows(spark):
    df = documents(spark, ["abc"], [None])
    assert hd.fit_prototypes(df) == {}
    assert [(r.lang_pred, r.score) for r in hd.predict(df, {}, ["doc_id"]).collect()] == [("und", 0.0)]
    assert hd.predict(df.limit(0), {}, ["doc_id"]).collect() == []
