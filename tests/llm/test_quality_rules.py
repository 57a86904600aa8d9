import re

from helpers import documents, invented, word_list
from pyspark.sql import functions as F

from siltstone.llm import quality_rules as qr


def plain(text):
    words = word_list(text, lower=False)
    text = text or ""
    lines = [x for x in text.split("\n") if word_list(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


TEXTS = [
    *invented(31, 60, words=(12, 60)),
    None,
    "",
    "\n \n\t",
    "a b c d e f a b c d e",
    "same line\nsame line\n same line\nsame line",
    "# $ %% <b>|x|</b> &amp; words enough to pass the ten words rule here now",
    "SHOUT! " * 20,
    "x y z w v " * 300,
    "one\x0btwo\x0cthree\rfour é 中文 😀",
    "\n\nend\n",
]


def plain_cut(values, spread):
    ranked = sorted(values)

    def quantile(quarters):
        return next(v for i, v in enumerate(ranked, 1) if 4 * i >= quarters * len(ranked))

    return quantile(2) + qr.SPREADS * max(quantile(3) - quantile(1), spread)


def test_counts_and_verdicts_match_plain_rules(spark):
    sources = [["a", "b", None][i % 3] if i % 7 else "rare" for i in range(len(TEXTS))]
    langs = [["en", None][i % 2] for i in range(len(TEXTS))]
    df = documents(spark, TEXTS, langs, sources).withColumn("n_words", F.lit("old"))
    df = df.unionByName(df.where("doc_id = 2"))
    rows = qr.quality_rules(df, min_docs=8).collect()
    assert len(rows) == len(TEXTS) + 1
    facts = [plain(t) for t in TEXTS]
    listed = [*range(len(TEXTS)), 2]

    def share(i, signal):
        numerator, denominator, _ = qr.SIGNALS[signal]
        return min(facts[i][numerator] * 1000 // max(facts[i][denominator], 1), 1000)

    for row in rows:
        i = row.doc_id
        assert {k: row[k] for k in facts[i]} == facts[i], TEXTS[i]
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        group = [k for k in listed if (langs[k], sources[k]) == (langs[i], sources[i])]
        level = "source"
        if len(group) < 8:
            group, level = [k for k in listed if langs[k] == langs[i]], "lang"
        whole = {s: plain_cut([share(k, s) for k in listed], qr.SIGNALS[s][2]) for s in qr.SIGNALS}
        passes = all(share(i, s) <= min(plain_cut([share(k, s) for k in group], qr.SIGNALS[s][2]), 2 * whole[s]) for s in qr.SIGNALS)
        assert (row.base_failed, row.level, row.kept) == (failed, level, not failed and passes)


def test_a_junk_source_does_not_set_its_own_standard(spark):
    clean = [t for t in invented(5, 300, words=(30, 60), vocabulary=3000)]
    junk = [t.replace(" ", " ### $$$ %%% ") for t in invented(6, 40, words=(30, 60), vocabulary=3000)]
    texts = [*clean, *junk]
    sources = ["good"] * 240 + ["bad"] * 60 + ["bad"] * 40
    kept = {r.doc_id: r.kept for r in qr.quality_rules(documents(spark, texts, sources=sources), min_docs=20).collect() if not r.base_failed}
    assert not any(kept.get(i) for i in range(300, 340))
    assert sum(kept.get(i, True) for i in range(300)) >= 295


def test_corpus_cutoffs_and_no_rows(spark):
    df = documents(spark, ["a b c d e f g h i j k"])
    assert [(r.level, r.kept) for r in qr.quality_rules(df).collect()] == [("corpus", True)]
    assert qr.quality_rules(df.limit(0)).collect() == []
