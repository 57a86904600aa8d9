"""Phrase collocations from weighted acyclic automata.

Every task cuts its texts into pieces and words, sorts the phrases of about SEGMENT_WORDS words and builds count
transducers from them (`automata.Transducer`). Phrases are dealt by prefix range: the range of their first three
words' code and, for four words, the range of the last word's code, so that even one prefix held by a third of all
phrases goes to many ranges. Per language and range the transducers are united, weights of equal phrases added, and
phrases below the least count left out; every part of a frequent phrase is frequent, so nothing that is asked for
later is lost.

Words come first, then pairs of frequent words, then phrases of three and four words whose pairs are all frequent. What was
frequent in one pass is told to the next by a Bloom filter of at most FILTER_BITS bits, which never denies a frequent phrase;
what it lets through by mistake is counted and left out with the other rare phrases.

The parts of a candidate lie in other ranges. Each range sends the parts it needs, sorted, as an acceptor to the
ranges where they stand; there it is composed with the transducer, the weights go back, and a part that its
longer phrase explains is marked on the way. No range, and no language, is gathered in one task.

Words are known by 64-bit hashes; their texts travel with the transducers of single words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .arrays import mix, pair, raw, slices, span_hashes, spans
from .automata import COLUMNS, DEPTH, FIELDS, Transducer, from_table, sort_keys, summed, union

# Words of one build, and words of the corpus per range and union; both bound the memory of a worker.
SEGMENT_WORDS = 1 << 20
RANGE_WORDS = 1 << 24
LEAST_RANGES = 16
# Lengths of the phrases that each pass builds.
PASSES = (1,), (2,), (3, 4)
# The filter of frequent phrases: bits per phrase, bits at most, and bits per row in which it is put together.
PHRASE_BITS = 16
FILTER_BITS = 1 << 28
FILTER_PART = 1 << 20
LEAST = 30
TOP = 2000
SCALE = 2_000_000
# A phrase goes if a longer one around it has this percentage of its count.
EXPLAINED = 80

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = _CUT.copy()
_BLANK[[0x20, 0x09]] = True
BLOCK = f"lang string, place long, {COLUMNS}"
UNITED = f"{BLOCK}, n long, kept long, word_keys array<long>, word_texts array<string>"
ASKED = "lang string, place long, home long, number binary, part binary, weight binary, labels binary, wanted binary"
ANSWERED = "lang string, place long, number binary, part binary, weight binary"
FOUND = "lang string, h1 long, h2 long, h3 long, h4 long, a long, l long, r long, score long"
# The parts of phrases of two, three and four words by their cuts, and the middle of four words.
PARTS = {
    2: ((0, 1), (1, 2)),
    3: ((0, 1), (1, 3), (0, 2), (2, 3)),
    4: ((0, 1), (1, 4), (0, 2), (2, 4), (0, 3), (3, 4), (1, 3)),
}


def piece_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, bytes]]:
    """Hashes of all words, whether each begins a piece, bounds per row, and the texts of the distinct words."""
    data, offsets = raw(column)
    starts, ends = spans(data, offsets, _BLANK)
    hashes = span_hashes(data, starts, ends, lower=True)
    hashes[hashes == 0] = 1
    bounds = np.searchsorted(starts, offsets)
    piece = np.searchsorted(np.flatnonzero(_CUT[data]), starts)
    begins = np.ones(len(starts), bool)
    begins[1:] = piece[1:] != piece[:-1]
    begins[bounds[:-1][bounds[:-1] < len(starts)]] = True
    kinds, at = np.unique(hashes, return_index=True)
    texts = {int(h): data[starts[i] : ends[i]].tobytes().lower() for h, i in zip(kinds, at)}
    return hashes, begins, bounds, texts


def prefix_ranges(paths: np.ndarray, wide: int, deep: int) -> np.ndarray:
    """The range of phrases given as rows of labels: `wide` ranges of prefixes, each cut in `deep` by the last word."""
    code = paths[:, 0]
    for at in range(1, DEPTH - 1):
        code = np.where(paths[:, at] != 0, pair(code, paths[:, at]), code)
    last = mix(np.where(paths[:, -1] != 0, paths[:, -1], code))
    scaled = [((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32) for x, n in ((code, wide), (last, deep))]
    return (scaled[0] * np.uint64(deep) + scaled[1]).astype(np.int64)


def phrase_bits(lang: str, words: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """The two bits of each phrase, given as columns of words, in a filter of `bits` bits, a power of two."""
    code = words[0]
    for word in words[1:]:
        code = pair(code, word)
    code = pair(code, np.uint64(crc32(lang.encode())))
    return np.stack([code >> np.uint64(32), code]) & np.uint64(bits - 1)


def _linked(lang: str, hashes: np.ndarray, follows: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Whether the pair of a word and the next may be part of a frequent phrase, by a filter of words or of pairs."""
    spots = np.arange(len(hashes)) if size == 1 else np.flatnonzero(follows)
    bits = phrase_bits(lang, [hashes[spots + at] for at in range(size)], len(known) * 8)
    held = ((known[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)
    out = np.zeros(len(hashes), bool)
    out[spots[held]] = True
    if size == 1:
        out[:-1] &= out[1:]
        out &= follows
    return out


def _phrases(lang: str, hashes: np.ndarray, begins: np.ndarray, sizes: Sequence[int], known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted labels, and the distinct phrases of the given lengths (rows of places from 1) with their counts.

    With `known`, the filter of the pass before, only phrases whose words or pairs it lets through.
    """
    # Whether the next word is in the same piece.
    linked = np.append(~begins[1:], False)
    if known is not None:
        linked = _linked(lang, hashes, linked, min(sizes) - 1, known)
    # Words that can be read on from each, itself included.
    room = np.ones(len(hashes) + 1, np.int8)
    for _ in range(max(sizes) - 1):
        room[:-1] = np.where(linked, room[1:] + 1, 1)
    room = room[:-1]
    # Words that stand in no phrase need no label.
    used = room >= min(sizes)
    for _ in range(max(sizes) - 1):
        used[1:] |= used[:-1] & linked[:-1]
    labels, place = np.unique(hashes[used], return_inverse=True)
    words = np.zeros(len(hashes), np.int32)
    words[used] = place + 1
    paths, counts = [], []
    for size in sizes:
        at = np.flatnonzero(room >= size)
        rows = np.zeros((len(at), DEPTH), np.int32)
        for step in range(size):
            rows[:, step] = words[at + step]
        rows, n = summed(rows, len(labels), np.ones(len(at), np.int64))
        paths.append(rows)
        counts.append(n)
    return labels, np.concatenate(paths), np.concatenate(counts)


def _row(**columns) -> pa.RecordBatch:
    kinds = {"lang": pa.string(), "place": pa.int64(), "home": pa.int64(), "n": pa.int64(), "kept": pa.int64()}
    kinds |= {"word_keys": pa.list_(pa.int64()), "word_texts": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in columns.items()], names=list(columns))


def _blocks(lang: str, phrases: tuple[np.ndarray, np.ndarray, np.ndarray], texts: dict[int, bytes], wide: int, deep: int) -> Iterator[pa.RecordBatch]:
    labels, paths, counts = phrases
    if not len(paths):
        return
    place = prefix_ranges(np.concatenate([np.zeros(1, np.uint64), labels])[paths], wide, deep)
    order = np.lexsort((*sort_keys(paths, len(labels))[::-1], place))
    paths, counts, place = paths[order], counts[order], place[order]
    edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
    for low, high in zip(edges[:-1], edges[1:]):
        part = paths[low:high]
        single = labels[part[part[:, 1] == 0][:, 0] - 1]
        built = Transducer.build(part, labels, counts[low:high])
        yield _row(lang=lang, place=int(place[low]), **built.to_bytes(), words=b" ".join(texts[int(h)] for h in single))


def _count(sizes: Sequence[int], wide: int, deep: int, known: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        texts: dict[int, bytes] = {}
        size = 0

        def build() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                hashes, begins = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                if len(hashes):
                    found = _phrases(lang, hashes, begins, sizes, None if known is None else np.frombuffer(known.value, np.uint8))
                    yield from _blocks(lang, found, texts, wide, deep)

        for batch in slices(batches):
            hashes, begins, bounds, found = piece_words(batch.column(1))
            if 1 in sizes:
                texts |= found
            langs = batch.column(0).dictionary_encode()
            rows = langs.indices.to_numpy(zero_copy_only=False)
            owner = np.repeat(rows, np.diff(bounds))
            for at, lang in enumerate(langs.dictionary.to_pylist()):
                own = owner == at
                held.setdefault(lang, []).append((hashes[own], begins[own]))
            size += len(hashes)
            if size >= SEGMENT_WORDS:
                yield from build()
                held, texts, size = {}, {}, 0
        yield from build()

    return run


def _unite(least: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = from_table(table)
        texts: dict[int, str] = {}
        n = 0
        for part, words in zip(parts, table.column("words").to_pylist()):
            paths = part.paths()
            single = (paths[:, 1] == 0) if len(paths) else np.zeros(0, bool)
            n += int(part.weights[single].sum())
            if single.any():
                texts |= zip(part.labels[paths[single][:, 0] - 1].tolist(), words.decode().split(" "))
        whole = union(parts, least)
        paths = whole.paths()
        single = whole.labels[paths[paths[:, 1] == 0][:, 0] - 1]
        words = [texts[h] for h in single.tolist()]
        lang, place = (x.as_py() for x in key)
        row = _row(lang=lang, place=place, **whole.to_bytes(), n=n, kept=len(paths), word_keys=single.view(np.int64).tolist(), word_texts=words)
        return pa.Table.from_batches([row])

    return run


def _mark(size: int, bits: int):
    """The bits of each range's phrases, which have `size` words, by the part of the filter they lie in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang, held in zip(table.column("lang").to_pylist(), from_table(table)):
                phrases = held.hashes()
                marks = np.unique(phrase_bits(lang, [phrases[:, at] for at in range(size)], bits))
                part = (marks // np.uint64(FILTER_PART)).astype(np.int64)
                for number in np.unique(part):
                    yield _row(place=int(number), marks=(marks[part == number] % np.uint64(FILTER_PART)).astype(np.uint32).tobytes())

    return run


def _merge_marks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    bits = np.zeros(FILTER_PART, bool)
    for marks in table.column("marks").to_pylist():
        bits[np.frombuffer(marks, np.uint32)] = True
    return pa.Table.from_batches([_row(place=key[0].as_py(), marks=np.packbits(bits, bitorder="little").tobytes())])


def phrase_filter(united: DataFrame, size: int) -> bytes:
    """A Bloom filter of all phrases of a pass, which have `size` words; 2 ** 20 to FILTER_BITS bits, as many as they ask for."""
    kept = united.agg(F.sum("kept")).first()[0] or 0
    bits = FILTER_PART
    while bits < min(kept * PHRASE_BITS, FILTER_BITS):
        bits *= 2
    marked = united.select("lang", *FIELDS).mapInArrow(_mark(size, bits), "place long, marks binary")
    out = np.zeros(bits // 8, np.uint8)
    # FILTER_BITS / FILTER_PART rows at most.
    for row in marked.groupBy("place").applyInArrow(_merge_marks, "place long, marks binary").collect():
        low = row.place * FILTER_PART // 8
        out[low : low + FILTER_PART // 8] = np.frombuffer(bytes(row.marks), np.uint8)
    return out.tobytes()


def _join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One transducer per language and range of what all passes found there."""
    lang, place = (x.as_py() for x in key)
    return pa.Table.from_batches([_row(lang=lang, place=place, **union(from_table(table)).to_bytes())])


def _ask(wide: int, deep: int):
    """Send each candidate's parts to the ranges where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang, home, held in zip(table.column("lang").to_pylist(), table.column("place").to_pylist(), from_table(table)):
                phrases = held.hashes()
                lengths = (phrases != 0).sum(axis=1)
                number, part, wanted = [], [], []
                for size, cuts in PARTS.items():
                    own = np.flatnonzero(lengths == size)
                    for low, high in cuts:
                        rows = np.zeros((len(own), DEPTH), np.uint64)
                        rows[:, : high - low] = phrases[own, low:high]
                        number.append(own)
                        part.append(np.full(len(own), low * 8 + high, np.uint8))
                        wanted.append(rows)
                number, part, wanted = (np.concatenate(x) for x in (number, part, wanted))
                place = prefix_ranges(wanted, wide, deep)
                order = np.argsort(place, kind="stable")
                number, part, wanted, place = number[order], part[order], wanted[order], place[order]
                edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])) if len(place) else []
                for low, high in zip(edges[:-1], edges[1:]):
                    labels, at = np.unique(wanted[low:high], return_inverse=True)
                    yield _row(
                        lang=lang,
                        place=int(place[low]),
                        home=home,
                        number=number[low:high].tobytes(),
                        part=part[low:high].tobytes(),
                        weight=held.weights[number[low:high]].tobytes(),
                        labels=labels.tobytes(),
                        wanted=at.astype(np.uint32).tobytes(),
                    )

    return run


def _answer(key: tuple[pa.Scalar, ...], own: pa.Table, asked: pa.Table) -> pa.Table:
    """Compose the acceptors with the range's transducer; weights go home, marks on explained phrases stay here."""
    lang, place = (x.as_py() for x in key)
    empty = pa.Table.from_batches([_row(lang=lang, place=place, number=b"", part=b"", weight=b"")]).slice(0, 0)
    if not own.num_rows or not asked.num_rows:
        return empty
    held = from_table(own)[0]
    out, explained = [], []
    for row in asked.to_pylist():
        labels, at = np.frombuffer(row["labels"], np.uint64), np.frombuffer(row["wanted"], np.uint32)
        wanted = labels[at].reshape(-1, DEPTH)
        met = held.compose(wanted)
        weights = held.weights[met]
        if (met < 0).any():
            raise ValueError("a part of a frequent phrase is missing")
        around = np.frombuffer(row["weight"], np.int64)
        explained.append(met[(wanted[:, 1] != 0) & (around >= -(-weights * EXPLAINED // 100))])
        out.append(_row(lang=lang, place=row["home"], number=row["number"], part=row["part"], weight=weights.tobytes()))
    gone = np.unique(np.concatenate(explained)).astype(np.int64)
    out.append(_row(lang=lang, place=place, number=gone.tobytes(), part=bytes(len(gone)), weight=np.zeros(len(gone), np.int64).tobytes()))
    return pa.Table.from_batches(out)


def exact_scores(a: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """floor(SCALE * a / sums), by Python numbers where 64 bits would not do."""
    if len(a) and int(a.max()) > (1 << 62) // SCALE:
        return (a.astype(object) * SCALE // sums.astype(object)).astype(np.int64)
    return a * SCALE // sums


def _rate(key: tuple[pa.Scalar, ...], own: pa.Table, answered: pa.Table) -> pa.Table:
    """The range's candidates that no longer phrase explains, at their lowest-scoring cut."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    kinds = pa.schema([(n, pa.string() if n == "lang" else pa.int64()) for n in names])
    if not own.num_rows or not answered.num_rows:
        return kinds.empty_table()
    held = from_table(own)[0]
    phrases = held.hashes()
    lengths = (phrases != 0).sum(axis=1)
    number, part, weight = (
        np.concatenate([np.frombuffer(x, kind) for x in answered.column(name).to_pylist()])
        for name, kind in (("number", np.int64), ("part", np.uint8), ("weight", np.int64))
    )
    of_part = np.zeros((len(phrases), 64), np.int64)
    of_part[number, part] = weight
    keep = lengths > 1
    keep[number[part == 0]] = False
    out = []
    for size in PARTS:
        rows = np.flatnonzero(keep & (lengths == size))
        a = held.weights[rows]
        best = None
        for cut in range(1, size):
            left, right = of_part[rows, cut], of_part[rows, cut * 8 + size]
            score = exact_scores(a, left + right)
            if best is None:
                best = [left, right, score]
            else:
                lower = score < best[2]
                best = [np.where(lower, new, old) for new, old in zip((left, right, score), best)]
        out.append(np.column_stack([phrases[rows].view(np.int64), a, *best]))
    found = np.concatenate(out)
    lang = pa.array([key[0].as_py()] * len(found), pa.string())
    return pa.Table.from_arrays([lang, *(pa.array(found[:, i]) for i in range(found.shape[1]))], schema=kinds)


def count_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame, int, int]:
    """The stored transducers of phrases that occur `least` times or more, one row per language and range; words; the range numbers."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About six bytes a word.
    places = max(size // 6 // RANGE_WORDS + 1, LEAST_RANGES)
    deep = isqrt(places)
    wide = -(-places // deep)
    keys = ("lang", "place")
    passes, known = [], None
    for sizes in PASSES:
        blocks = docs.mapInArrow(_count(sizes, wide, deep, known), f"{BLOCK}, words binary")
        path = scratch_path(spark, "phrases")
        blocks.groupBy(*keys).applyInArrow(_unite(least), UNITED).write.parquet(path)
        passes.append(spark.read.schema(UNITED).parquet(path))
        if sizes != PASSES[-1]:
            known = spark.sparkContext.broadcast(phrase_filter(passes[-1], sizes[-1]))
    path = scratch_path(spark, "phrases")
    sides = [united.select(*keys, *FIELDS) for united in passes]
    reduce(DataFrame.unionByName, sides).groupBy(*keys).applyInArrow(_join, BLOCK).write.parquet(path)
    return spark.read.schema(BLOCK).parquet(path), passes[0].select("lang", "n", "word_keys", "word_texts"), wide, deep


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of two to four words of each language.

    A-Z are lower-cased; texts are split at . , ; : ! ? and line ends into pieces, and these at blanks and tabs into words. a is the
    count of a phrase, l and r those of its parts at the cut with the lowest score floor(2000000 a / (l + r)),
    n that of all words. Phrases with a < `least` are none, and those that lie in a longer one with 80 percent of
    their count go. Order: score and a descending, then the phrase's bytes.

    NULL texts are empty and give nothing, a NULL language is `und`. Repeated rows and texts count each time.
    Long texts are read in slices. An empty table, and a language without a phrase, give no row. Other columns
    are not read, whatever their names.
    """
    stored, spoken, wide, deep = count_phrases(df, text, lang, least)
    keys = ("lang", "place")
    asked = stored.mapInArrow(_ask(wide, deep), ASKED)
    answers = stored.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_answer, ANSWERED)
    rated = stored.groupBy(*keys).cogroup(answers.groupBy(*keys)).applyInArrow(_rate, FOUND)
    # Ties at the end are kept until phrases have their texts.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = rated.withColumn("rank", F.rank().over(order)).where(F.col("rank") <= top).drop("rank")
    spelled = best.select(*best.columns, F.posexplode(F.array("h1", "h2", "h3", "h4")).alias("at", "h")).where("h <> 0")
    words = spoken.select("lang", F.explode(F.arrays_zip(F.col("word_keys").alias("h"), F.col("word_texts").alias("word"))).alias("w")).select("lang", "w.*")
    spelled = spelled.join(words, ["lang", "h"]).groupBy(*best.columns).agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    named = spelled.select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", "l", "r", "score")
    ranked = named.withColumn("rank", F.row_number().over(order.orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    totals = spoken.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
