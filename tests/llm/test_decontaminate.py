import random
import re

import pyarrow as pa
from helpers import documents
from pyspark.sql import functions as F

from siltstone.llm import decontaminate
from siltstone.llm.decontaminate import contamination

ITEMS = [
    (1, "Alice has 3 apples and Bob has 5 apples. How many apples do Alice and Bob have together in all?"),
    (2, "A train runs 60 km in 2 hours, how far does the same train run at this speed in 7 hours?"),
    (3, "short item here now"),
    (4, None),
    (5, ""),
    (6, "Alice has 3 apples and Bob has 5 apples. How many apples do Alice and Bob have together in all?"),
    (None, "nobody asks this long question with no number at all please"),
    (7, "tiny two"),
]
TEXTS = {
    0: "Before it. " + ITEMS[0][1] + " After it.",
    1: "Carol has 12 apples and Dave has 40 apples. How many apples do Carol and Dave have together in all?",
    2: "words words. Carol has 12 apples and Dave has 40 apples. How many apples do Erin and Dave have",
    3: "a train runs 95 miles in 4 hours how far does the same train run at this speed in 11 hours",
    4: "A TRAIN RUNS 60 KM IN 2 HOURS, HOW FAR DOES THE SAME TRAIN RUN AT THIS SPEED IN 7 HOURS?",
    5: "an item that is short, here an item now, short item",
    6: "so: Short item here now!",
    7: None,
    8: "",
    9: "tiny two " * 20_000,
    10: "has 3 apples and has 5 apples, three of a kind of words with nothing else the same",
    11: "Nobody asks this long question with no number at all please",
}


def run(spark, **more):
    ids = sorted(TEXTS)
    df = documents(spark, [TEXTS[i] for i in ids]).withColumn("item_ids", F.lit("old"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {r.doc_id: r for r in contamination(df, items, **more).collect()}


def test_verbatim_reparameterised_and_inconsistent_questions(spark):
    for block_bytes in (1 << 20, 40):
        found = run(spark, block_bytes=block_bytes)
        assert len(found) == len(TEXTS)
        assert found[0].item_ids == [1, 6] and found[0].verbatim
        assert found[1].item_ids == [1, 6] and not found[1].verbatim and found[1].matched_tokens == found[0].matched_tokens
        # Erin stands where Carol should, so the run is cut there.
        assert found[2].matched_tokens < found[1].matched_tokens
        assert found[3].item_ids == [2] and not found[3].verbatim
        assert found[4].item_ids == [2]
        assert found[6].item_ids == [3] and found[6].matched_tokens == 4
        assert [i for i in (5, 7, 8, 9, 10, 11) if found[i].contaminated] == []


def test_keeps_columns_and_handles_no_rows(spark):
    found = run(spark, keep=["doc_id", "text", "item_ids", "n_chars"])
    assert found[1].text == TEXTS[1] and found[1].item_ids == [1, 6]
    df = documents(spark, ["a b c d e f g h i"])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in contamination(df, none).collect()] == [False]
    assert contamination(df.limit(0), none).collect() == []


def matches(spark, items, texts):
    df = documents(spark, texts)
    return {r.doc_id: r for r in contamination(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}


def test_verbatim_items_of_numbers_and_short_questions(spark):
    items = ["What is 12 times 34?", "Compute 12 + 34 + 56 + 78 + 90", "1.5 2.5 | 3.5 4.5 | 5.5 6.5 | 7.5 8.5 | 9.5 10.5"]
    texts = [f"Before {item} after" for item in items] + ["What is 12 times 35?", "Compute 12 + 34 + 56 + 78 + 91"]
    found = matches(spark, items, texts)
    assert [found[i].item_ids for i in range(5)] == [[0], [1], [2], [], []]
    assert all(found[i].verbatim for i in range(3))


def test_scripts_without_blanks_and_marks_beyond_ascii(spark):
    chinese = "一列火车以每小时六十公里的速度行驶，两小时后它走了多远？"
    thai = "รถไฟวิ่งด้วยความเร็วหกสิบกิโลเมตรต่อชั่วโมงเป็นเวลาสองชั่วโมง"
    quoted = "which of the farmer's “seven” dogs didn't come — when it was called"
    texts = [f"前文{chinese}后文", f"ก่อน{thai}หลัง", quoted.replace("'", "\u2019").replace("“seven”", "'seven'").replace(" — ", "\u2014"), "每小时六十公里的", "กิโลเมตรต่อ", None]
    found = matches(spark, [chinese, thai, quoted], texts)
    assert [found[i].item_ids for i in range(6)] == [[0], [1], [2], [], [], []]


def test_common_frames_around_other_names_are_clean(spark):
    item = "Die Leute sangen gestern in der Kirche und in der Welt zu ihrer Freude viele alte Lieder"
    texts = ["Wir waren in der Schule und in der Stadt zu Hause", "Sie sangen in der Kirche und in der Welt zu laut", item.replace("Kirche", "Schule")]
    found = matches(spark, [item], texts)
    assert [found[i].item_ids for i in range(3)] == [[], [0], [0]]


def test_ids_of_text(spark):
    df = documents(spark, [ITEMS[0][1], "nothing of it"])
    items = spark.createDataFrame([("gsm-1", ITEMS[0][1], 1), ("a", ITEMS[0][1], 2), ("a", ITEMS[0][1], 2)], "item_id string, text string, matched_tokens int")
    for block_bytes in (1 << 20, 40):
        found = {r.doc_id: r.item_ids for r in contamination(df.unionByName(df), items, block_bytes=block_bytes).collect()}
        assert found == {0: ["a", "gsm-1"], 1: []}


def test_items_of_one_template_share_an_entry(spark):
    frame = "{0} has {1} apples and {2} has {3} apples. How many apples do {0} and {2} have together in all?"
    names = ["Alice", "Bob", "Carol", "Dave", "Erin"]
    items = [(i, frame.format(names[i % 5], i + 3, names[(i + 1) % 5], i + 1000)) for i in range(300)]
    units = decontaminate._units()
    tokens = decontaminate.read_tokens(pa.array([t for _, t in items]), units)
    assert len(decontaminate.build_block(list(range(300)), tokens, units).ids) == 1
    assert len(decontaminate.build_block(list(range(300)), tokens.without_slots(), units).ids) == 300
    df = documents(spark, [frame.format("Zoe", 7, "Yan", 8), items[4][1], frame.format("Zoe", 7, "Zoe", 7)])
    found = {r.doc_id: r for r in contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found[0].item_ids == list(range(300)) and not found[0].verbatim
    assert found[1].item_ids == list(range(300)) and found[1].verbatim
    assert found[2].matched_tokens < found[0].matched_tokens


def plain_tokens(text):
    """(kind, lower-cased value) of each token of ASCII text."""
    out = []
    for match in re.finditer(r"\d+(?:[.,]\d+)*|[A-Za-z]+(?:'[A-Za-z]+)*", text or ""):
        word = match.group()
        kind = "number" if word[0].isdigit() else "name" if word[0].isupper() and not word[1:2].isupper() else "word"
        if kind != "number" and word.lower() in decontaminate.UNITS and out and out[-1][0] == "number":
            kind = "unit"
        out.append((kind, word.lower()))
    return out


def plain_runs(item, doc, window, changed, least_words):
    """The longest consistent run of an item in a document, by laying one on the other at every place, as (length, verbatim)."""
    best = (0, False)
    for names in (True, False):
        for exact in (True, False):
            own, other = ([("word" if exact or (k == "name" and not names) else k, v) for k, v in x] for x in (item, doc))
            size = min(window, len(own))
            if len(own) < decontaminate.LEAST_TOKENS:
                continue
            for shift in range(-len(own), len(other)):
                fits = [
                    p for p in range(len(own) - size + 1)
                    if 0 <= p + shift and p + shift + size <= len(other)
                    and all(own[p + k][0] == other[p + shift + k][0] and (own[p + k][0] != "word" or own[p + k] == other[p + shift + k]) for k in range(size))
                    and sum(own[p + k][0] == "word" for k in range(size)) >= min(least_words, size)
                ]
                start, there, back, reached = None, {}, {}, -1
                for p in [*fits, None]:
                    for fresh in (False, True):
                        if start is not None and (p is None or fresh or p > reached):
                            if reached - start == len(own) or reached - start >= (window if exact else changed):
                                best = max(best, (reached - start, exact))
                            start, there, back, reached = None, {}, {}, -1
                        if p is None:
                            break
                        new_there, new_back, fine = dict(there), dict(back), True
                        for k in range(max(p, reached), p + size):
                            (kind, value), (_, given) = own[k], other[k + shift]
                            if kind != "word":
                                fine &= new_there.setdefault((kind, value), given) == given and new_back.setdefault((kind, given), value) == value
                        if fine:
                            start, there, back, reached = p if start is None else start, new_there, new_back, p + size
                            break
                        if start is None:
                            break
    return best


def test_runs_match_laying_items_on_documents(spark):
    rnd = random.Random(12)
    words = "the of and train runs far does same speed apples together".split()

    def text(count):
        parts = []
        for _ in range(count):
            kind = rnd.random()
            parts.append(rnd.choice(words) if kind < 0.6 else str(rnd.randrange(4)) if kind < 0.75 else rnd.choice(["Ann", "Bob", "Cy"]) if kind < 0.9 else rnd.choice(["3 km", "5 kg"]))
        return " ".join(parts)

    def spoilt(item):
        own = item.split(" ")
        low = rnd.randrange(max(1, len(own) // 2))
        own = own[low : low + rnd.randint(6, 40)]
        swap = {w: rnd.choice(["Dan", "Eve", w]) for w in ("Ann", "Bob", "Cy")} | {str(i): str(rnd.choice([i, i + 10])) for i in range(4)}
        own = [swap.get(w, w) if rnd.random() < 0.97 else rnd.choice(words) for w in own]
        return " ".join([text(4), *own, text(4)])

    items = [(i, text(rnd.choice([3, 6, 14, 30]))) for i in range(14)]
    docs = [spoilt(rnd.choice(items)[1]) if rnd.random() < 0.85 else text(40) for _ in range(80)]
    found = {r.doc_id: r for r in contamination(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    tokens = [plain_tokens(t) for _, t in items]
    kinds = set()
    for at, doc in enumerate(docs):
        runs = {i: plain_runs(tokens[i], plain_tokens(doc), decontaminate.WINDOW, decontaminate.CHANGED, decontaminate.LEAST_WORDS) for i, _ in items}
        expected = sorted(i for i, run in runs.items() if run[0])
        longest = max(runs.values())
        assert (found[at].item_ids, (found[at].matched_tokens, found[at].verbatim)) == (expected, longest), (doc, runs)
        kinds.add(longest[0] and longest[1])
    assert kinds == {0, False, True} or kinds == {False, True}
