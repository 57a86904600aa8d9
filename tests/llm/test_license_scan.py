import random
import re

import pytest
from helpers import documents, lowered

from siltstone.llm.license_scan import GAP, PHRASES, RUN, TEMPLATES, license_spans, scan_licenses, votes

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return [w.decode() for w in WORD.findall(lowered(text))]


def plain(text, phrases, templates, share=60):
    """(n_words, n_base, first, last, base_labels, labels, score) by looking at every place."""
    words = words_of(text)
    places = [(i, label) for phrase, label in phrases.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels, score = {label for _, label in places}, 1.0 if places else 0.0
    for template, label in templates.items():
        known = template.split()
        met = sorted(
            (p - q, q, p) for q in range(len(known) - RUN + 1) for p in range(len(words) - RUN + 1) if words[p : p + RUN] == known[q : q + RUN]
        )
        bands = []
        for diagonal, q, p in met:
            if not bands or diagonal - bands[-1][-1][0] > GAP:
                bands.append([])
            bands[-1].append((diagonal, q, p))
        for band in bands:
            parts = []
            for p, q in sorted((p, q) for _, q, p in band):
                if not parts or p - parts[-1][-1][0] > len(known):
                    parts.append([])
                parts[-1].append((p, q))
            for part in parts:
                covered = len({q + i for _, q in part for i in range(RUN)})
                if covered * 100 >= share * len(known):
                    labels.add(label)
                    score = max(score, covered / len(known))
    at = [i for i, _ in places]
    joined = [",".join(sorted(x)) for x in ({label for _, label in places}, labels)]
    return (len(words), len(places), min(at, default=None), max(at, default=None), *joined, score)


def texts(seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            if kind < 0.4:
                parts.append(rnd.choice(list(PHRASES)).upper().replace(" ", rnd.choice([" ", "\n", " -- ", "x"])))
            elif kind < 0.8:
                words = rnd.choice(list(TEMPLATES)).split()
                for _ in range(rnd.choice([0, 0, 1, 3, 12])):
                    at = rnd.randrange(len(words))
                    words[at : at + rnd.choice([0, 1])] = rnd.choice([["foo"], [], ["the", "software"]])
                parts.append(" ".join(words))
            else:
                parts.append(" ".join(rnd.choice(["the", "license", "cc", "by", "mit", "apache", "é", "x1"]) for _ in range(rnd.randint(0, 30))))
        out.append(rnd.choice([" ", ". ", "\n"]).join(parts))
    return out


def test_places_votes_and_labels_match_brute_force(spark):
    long = " ".join(["w"] * 50_000 + ["mit", "license"] + ["w"] * 1000 + list(TEMPLATES)[0].split())
    given = [*texts(1), None, "", "...", "MIT", "MIT \x00 License", "MKT licenſe CC BY", "cc by cc by cc", long]
    found = {r.doc_id: tuple(r)[1:] for r in scan_licenses(documents(spark, given)).collect()}
    expected = {i: plain(t, PHRASES, TEMPLATES) for i, t in enumerate(given)}
    assert found == expected
    assert {len(e[5].split(",")) for e in expected.values()} > {1, 2}


def test_spans_of_changed_and_repeated_notices(spark):
    notice = list(TEMPLATES)[0].split()
    changed = notice[:20] + ["and", "so", "on"] + notice[20:40] + notice[43:]
    text = " ".join(["before"] * 9 + changed + ["between"] * 30 + notice)
    spans = sorted((r.first_word, r.end_word, r.label) for r in license_spans(documents(spark, [text]), phrases={}).collect())
    assert [s[2] for s in spans] == ["mit", "mit"]
    assert spans[0][:2] == (9, 9 + len(changed)) and spans[1][1] == len(text.split())


def test_repeated_rows_null_keys_clashing_columns_and_no_rows(spark):
    df = documents(spark, ["MIT License", "MIT License and cc by", None])
    df = df.unionByName(df.where("doc_id = 0")).unionByName(df.selectExpr("CAST(NULL AS long) AS doc_id", "text", "lang", "source", "n_chars"))
    df = df.unionByName(df.selectExpr("CAST(1 AS long) AS doc_id", "'other text' AS text", "lang", "source", "n_chars").limit(1))
    df = df.withColumnsRenamed({"lang": "key", "source": "th", "n_chars": "label"})
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.n_base, r.labels) for r in scan_licenses(df).collect())
    assert rows == [(False, 0, 1, "mit"), (False, 0, 1, "mit"), (False, 1, 0, ""), (False, 1, 2, "cc-by,mit"), (False, 2, 0, ""), (True, 0, 0, ""), (True, 0, 1, "mit"), (True, 0, 2, "cc-by,mit")]
    assert scan_licenses(df.limit(0)).collect() == []
    assert [r.n_base for r in scan_licenses(df.where("doc_id = 0"), phrases={}, templates={}).collect()] == [0, 0]
    with pytest.raises(ValueError):
        scan_licenses(df, phrases={"one": "x"})


def test_no_python_in_the_plan(spark):
    for df in (scan_licenses(documents(spark, ["mit license"])), votes(documents(spark, ["a"]), "doc_id", "text", PHRASES, TEMPLATES)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
