import random

from helpers import documents, invented, word_list

from siltstone.llm import line_dedup
from siltstone.llm.line_dedup import dedup_lines, repeated_lines


def plain(texts, percent=80):
    """Line numbers to remove per text, by comparing every line with all before it."""
    seen, out = [], {}
    for i, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            own = frozenset(word_list(line, lower=False))
            if not own:
                continue
            if any(100 * len(own & s) >= percent * len(own | s) for s in seen):
                out.setdefault(i, []).append(k)
            seen.append(own)
    return out


def lines_of(seed):
    texts = invented(seed, 40, words=(0, 50), vocabulary=60)
    return ["\n".join(texts[i : i + 1 + i % 4]) for i in range(0, len(texts), 2)]


def test_removed_lines_match_brute_force(spark):
    texts = [*lines_of(5), None, "", "\n\n", "one\ntwo\none", "x " * 30 + "\n" + "x y", "\t a\x0bb\rc d \n\nd  c b a", *["same words in many a row\n"] * 40]
    long = " ".join(f"w{i}" for i in range(5000))
    texts += [long, long + " more", long.replace("w77 ", "")]
    df = documents(spark, texts)
    for percent in (80, 90):
        expected = plain(texts, percent)
        found = {r.key: r.removed for r in repeated_lines(df, percent=percent).collect()}
        assert {k: v for k, v in found.items() if v} == expected
    kept = {r.doc_id: r for r in dedup_lines(df).collect()}
    expected = plain(texts)
    assert len(kept) == len(texts)
    for i, text in enumerate(texts):
        left = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in expected.get(i, []))
        if i in expected and not word_list(left):
            left = ""
        assert kept[i].text == left and kept[i].lang == "en"


def test_groups_of_near_copies(spark):
    rnd = random.Random(8)
    texts = []
    for family in range(4):
        base = [f"f{family}w{k}" for k in range(60)]
        for _ in range(25):
            own = list(base)
            for at in rnd.sample(range(60), rnd.randint(0, 12)):
                own[at] = f"x{rnd.randrange(40)}"
            texts.append(" ".join(own))
    rnd.shuffle(texts)
    found = {r.key: r.removed for r in repeated_lines(documents(spark, texts)).collect()}
    assert {k: v for k, v in found.items() if v} == plain(texts)


def test_pairs_do_not_follow_the_square_of_a_group(spark, monkeypatch):
    """Members of a group that are about as alike as the limit find a match among a few others."""
    rnd, size = random.Random(3), 240
    texts = [" ".join(f"w{k}" if rnd.random() > 0.05 else f"x{rnd.randrange(10**6)}" for k in range(60)) for _ in range(size)]
    compared, matched = [], line_dedup.matched

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return matched(pairs, sets, percent)

    monkeypatch.setattr(line_dedup, "matched", counted)
    found = {r.key: r.removed for r in repeated_lines(documents(spark, texts)).collect()}
    expected = plain(texts)
    assert {k: v for k, v in found.items() if v} == expected and size // 2 < len(expected) < size - 1
    assert compared[0] <= 2 * size and sum(compared) <= 4 * size


def test_a_pair_meets_once_for_each_run_of_common_words(spark, monkeypatch):
    """Classes without a match in a group of near copies share most prefix words with all the group."""
    rnd, size, met = random.Random(4), 120, []
    texts = [" ".join(f"w{k}" if rnd.random() > 0.08 else f"x{rnd.randrange(10**6)}" for k in range(90)) for _ in range(size)]
    # Copies of rows and of lines stand for one class each.
    df = documents(spark, texts + texts[:20]).unionByName(documents(spark, texts[:30]))
    made = line_dedup.met_pairs

    def counted(*args):
        met.append(made(*args).checkpoint())
        return met[-1]

    monkeypatch.setattr(line_dedup, "met_pairs", counted)
    found = {r.key: r.removed for r in repeated_lines(df).collect()}
    assert {k: v for k, v in found.items() if v} == plain(texts + texts[:20])
    pairs = met[0].distinct().count()
    assert pairs > size and met[0].count() <= 2 * pairs


def test_leaders_keep_a_group_out_of_the_prefix_join(spark, monkeypatch):
    """Members that no likely pair settles meet the classes others were matched with, before all the group; also without broadcasts."""
    rnd, size, met = random.Random(12), 400, []
    texts = [" ".join(f"w{k}" if rnd.random() > 0.06 else f"x{rnd.randrange(10**6)}" for k in range(60)) for _ in range(size)]
    made = line_dedup.met_pairs

    def counted(*args):
        met.append(made(*args).checkpoint())
        return met[-1]

    monkeypatch.setattr(line_dedup, "met_pairs", counted)
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    # Equal rows stand for one document.
    df = documents(spark, texts).unionByName(documents(spark, texts[:40]))
    found = {r.key: r.removed for r in repeated_lines(df).collect()}
    assert {k: v for k, v in found.items() if v} == plain(texts)
    assert met[0].count() <= size


def test_sets_that_share_a_hash_are_told_apart(spark):
    rows = [(1, 10, 0, 7, 70), (2, 20, 0, 7, 71), (3, 30, 1, 7, 70), (4, 40, 0, 8, 80), (None, 50, 0, 8, 80)]
    for some, classes in ((rows, {(2, 1), (1, 2), (2, 4)}), (rows[3:], {(2, 4)})):
        stored = spark.createDataFrame(some, "key long, th long, line_no int, d long, d2 long")
        lines, known = line_dedup.told_apart(stored)
        assert {(r.lines, r.first.key) for r in known.collect()} == classes and set(known.columns) == {"d", "lines", "first"}
        assert lines.join(known, "d").count() == len(some) and "d2" not in lines.columns


def test_order_of_words_is_nothing_to_a_class(spark):
    """Sets written in several orders, with a match after them, keep their first line."""
    rnd, texts = random.Random(6), []
    for family in range(30):
        words = [f"f{family}w{k}" for k in range(20)]
        for _ in range(4):
            texts.append(" ".join(rnd.sample(words, 20) + rnd.sample(words, 3)))
            texts.append(" ".join([*rnd.sample(words, 20), f"more{len(texts)}"]))
    found = {r.key: r.removed for r in repeated_lines(documents(spark, texts)).collect()}
    assert {k: v for k, v in found.items() if v} == plain(texts)


def test_repeated_rows_null_keys_clashing_columns_and_no_rows(spark):
    df = documents(spark, ["a b c d e", "a b c d e f", "z"])
    df = df.unionByName(df.where("doc_id = 0")).unionByName(df.selectExpr("CAST(NULL AS long) AS doc_id", "text", "lang", "source", "n_chars"))
    df = df.withColumnsRenamed({"lang": "line", "source": "words", "n_chars": "d"})
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in dedup_lines(df).collect()))
    # Equal rows stand at the same place; NULL keys come last.
    assert rows == [(False, 0, "a b c d e"), (False, 0, "a b c d e"), (False, 1, ""), (False, 2, "z"), (True, 0, ""), (True, 0, ""), (True, 0, "")]
    assert dedup_lines(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    df = documents(spark, ["a b c d e"])
    text = dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
