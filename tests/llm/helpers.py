"""Small frames and plain counterparts shared by the tests of siltstone.llm."""

import random
import re

from siltstone.llm.queries import ship_package

BLANK = re.compile(rb"[\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, langs=None, sources=None, first=0):
    ship_package(spark)
    rows = [
        (i + first, t, langs[i] if langs else "en", sources[i] if sources else "s", None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def word_list(text, lower=True):
    data = lowered(text) if lower else (text or "").encode()
    return [w for w in BLANK.split(data) if w]


def invented(seed, count, words=(0, 60), vocabulary=80):
    """Texts of invented words, with copies and near copies."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 6))) for _ in range(vocabulary)]
    out = []
    for _ in range(count):
        if out and rnd.random() < 0.4:
            near = rnd.choice(out).split(" ")
            for _ in range(rnd.randint(0, 3)):
                near[rnd.randrange(len(near))] = rnd.choice(vocab)
            out.append(" ".join(near))
        else:
            out.append(" ".join(rnd.choice(vocab) + rnd.choice(["", "", "", ".\n", "\t"]) for _ in range(rnd.randint(*words))))
    return out


def closed(links, nodes):
    """Smallest member of each node's component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
