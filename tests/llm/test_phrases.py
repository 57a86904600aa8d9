import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import documents, lowered

from siltstone.llm import phrases
from siltstone.llm.automata import DEPTH, Transducer, summed, union
from siltstone.llm.phrases import collocations, exact_scores


def plain(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting all phrases in dictionaries."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", lowered(text)):
            words = [w for w in re.split(rb"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= 80 * f[p[i:j]]}
        rated = []
        for p, a in frequent.items():
            if p not in gone:
                score, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, b" ".join(p), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def wordy(seed, count):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "c", "dé", "e-f", "x\x1fy", "(g)"]
    return [
        "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","]) for _ in range(rnd.randint(0, 40))) for _ in range(count)
    ]


def found(df, **how):
    return sorted((tuple(r) for r in collocations(df, **how).collect()), key=repr)


def test_phrases_match_dictionaries(spark, monkeypatch):
    texts = [*wordy(2, 120), None, "", " \t", ".,;", "A b a b " * 3000]
    langs = [["en", "de", None, "und"][i % 4] for i in range(len(texts))]
    df = documents(spark, texts, langs)
    for least, top in ((3, 1000), (30, 7)):
        expected = plain(zip(langs, texts), least, top)
        assert expected and found(df, least=least, top=top) == expected
    # Many ranges of prefixes and last words, and repeated rows with columns of clashing names.
    monkeypatch.setattr(phrases, "LEAST_RANGES", 60)
    again = df.unionByName(df).withColumnsRenamed({"source": "phrase", "n_chars": "rank"})
    assert found(again, least=4) == plain([*zip(langs, texts)] * 2, 4, 2000)


def test_empty_tables_and_languages_without_phrases(spark):
    df = documents(spark, ["one two three", None])
    assert found(df) == [] and found(df.limit(0)) == []


def test_scores_beyond_64_bits():
    a, sums = np.array([3 * 10**15, 5]), np.array([7 * 10**15, 11])
    assert exact_scores(a, sums).tolist() == [2000000 * 3 * 10**15 // (7 * 10**15), 2000000 * 5 // 11]
    assert exact_scores(a[1:], sums[1:]).tolist() == [909090]


def test_a_prefix_held_by_all_goes_to_many_ranges():
    paths = np.array([[1, 2, 3, 4 + i] for i in range(2000)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(np.unique(phrases.prefix_ranges(paths, 8, 8))) == 8
    shorter = paths.copy()
    shorter[:, 3] = 0
    assert len(np.unique(phrases.prefix_ranges(shorter, 8, 8))) == 1


def transducer(counts):
    labels = np.array(sorted({x for p in counts for x in p}), np.uint64)
    place = {int(x): i + 1 for i, x in enumerate(labels)}
    paths = np.array([[place[x] for x in p] + [0] * (DEPTH - len(p)) for p in counts], np.int64).reshape(-1, DEPTH)
    paths, weights = summed(paths, len(labels), np.array(list(counts.values()), np.int64))
    return Transducer.from_bytes(Transducer.build(paths, labels, weights).to_bytes())


def read_off(held):
    return {tuple(int(x) for x in p if x): int(n) for p, n in zip(held.hashes(), held.weights)}


def test_transducers_build_unite_and_compose():
    for seed in range(60):
        rnd = random.Random(seed)
        parts, whole = [], Counter()
        for _ in range(rnd.randint(0, 4)):
            counts = Counter()
            for _ in range(rnd.randint(0, 80)):
                counts[tuple(rnd.randint(1, rnd.choice([2, 9, 70000])) for _ in range(rnd.randint(1, DEPTH)))] += rnd.randint(1, 300)
            parts.append(transducer(counts))
            assert read_off(parts[-1]) == counts
            whole += counts
        least = rnd.choice([0, 200])
        held = union(parts, least)
        kept = {p: n for p, n in whole.items() if n >= least}
        assert read_off(held) == kept
        asked = [*whole, (5,), (10**9, 1), (1, 1, 1, 1)]
        at = held.compose(np.array([[*p, *[0] * (DEPTH - len(p))] for p in asked], np.uint64))
        assert [int(held.weights[i]) if i >= 0 else None for i in at] == [kept.get(p) for p in asked]


def test_states_with_one_ending_are_shared():
    counts = {(first, second, 7, 8): 1 for first in range(10, 40) for second in range(50, 60)}
    held = transducer(counts)
    # End, before 8, before 7, after each first word the same, and the start.
    assert len(held.arcs) == 5
