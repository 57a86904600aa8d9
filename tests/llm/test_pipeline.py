from helpers import documents

import corpus_pipeline
from siltstone.llm.queries import ORACLES, PIECES, QUERIES
from siltstone.llm.sentencepiece_codec import PieceCodec


def test_stages_decide_as_planted(spark, tmp_path):
    clean = [" ".join(f"word{i}x{k}" for k in range(50)) for i in range(12)]
    leak = "Which of these seven planets has the largest moon that anybody has ever seen from here"
    near = clean[3].replace("word3x9 ", "").replace("word3x30", "other")
    own = "own line of this text that goes on for so many words that more than a third of it is left " * 3
    again = "a line of its own that one document says six times over"
    texts = [*clean, clean[2], near, "before " + leak + " after", "12345 678", None, clean[0] + "\n" + own, clean[1] + "\nshort rest", "", "\n".join([again] * 6)]
    folder = str(tmp_path)
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, columns = spark.read.parquet(f"{folder}/documents.parquet"), None
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == columns
    assert set(kept["language_id"]) == set(range(15)) | {17, 18, 20}
    # The exact and the near copy hold no line of their own; text 17 keeps its own line, and too little is left of text 18.
    assert set(kept["line_dedup"]) == set(range(12)) | {14, 17, 20} and kept["line_dedup"][20].text == again
    assert kept["line_dedup"][17].text == own and kept["line_dedup"][17].n_chars == len(own)
    assert set(kept["decontamination"]) == set(range(12)) | {17, 20}
    assert kept["sentencepiece"][5].n_tokens == len(PieceCodec(PIECES).encode(clean[5]))
    again = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert again == kept["sentencepiece"]


def test_texts_with_letters_stay_without_languages(spark, tmp_path):
    texts = ["some words", "12345 678", None, "other words", ""]
    for docs in (documents(spark, texts, langs=[None] * 5), documents(spark, texts)):
        kept = corpus_pipeline.identify_language(spark, docs, str(tmp_path)).collect()
        assert sorted(r.doc_id for r in kept) == [0, 3]


def test_missing_and_wrong_languages_are_set_right(spark, tmp_path):
    words = {"aa": "bad cab fad dad face bead deaf cafe".split(), "bb": "lily pony ploy join moon nil pool oil".split()}
    texts = [" ".join(words[lang][(i + k * k) % 8] for k in range(40)) for lang in ("aa", "bb") for i in range(30)]
    langs = ["aa"] * 30 + ["bb"] * 30
    langs[3], langs[7], langs[40] = None, "bb", "aa"
    # One of both languages alike keeps what it is given.
    texts.append(" ".join(words["aa"] + words["bb"]))
    langs.append("bb")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, documents(spark, texts, langs), str(tmp_path)).collect()}
    assert [kept[i] for i in range(61)] == ["aa"] * 30 + ["bb"] * 31


def test_near_duplicates_of_one_group_leave_one(spark, tmp_path):
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(base), " ".join(base[:200] + ["x"] + base[200:]), " ".join(base[:390])]
    kept = corpus_pipeline.remove_near_duplicates(spark, documents(spark, texts), str(tmp_path)).collect()
    assert [r.doc_id for r in kept] == [0]


def test_near_duplicates_with_repeated_ids_leave_one_row(spark, tmp_path):
    base, other, third = ([f"{x}{k}" for k in range(400)] for x in "abc")
    texts = [" ".join(base), " ".join(base[:390]), " ".join(other), " ".join(third), " ".join(third[:390]), " ".join(third), None]
    rows = [(i, t, "en", "s", 0) for i, t in zip([1, 2, 2, 5, 5, 5, 5], texts)]
    docs = spark.createDataFrame(rows, documents(spark, ["a"]).schema)
    kept = [(r.doc_id, (r.text or "-")[0]) for r in corpus_pipeline.remove_near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == [(1, "a"), (2, "b"), (5, "-"), (5, "c")]
    equal = corpus_pipeline.remove_near_duplicates(spark, docs.where("text LIKE 'c0%c399'"), str(tmp_path)).collect()
    assert [(r.doc_id, r.text) for r in equal] == [(5, texts[3])]


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
