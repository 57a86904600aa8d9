"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram of letters a, b, c is bound as
shift(shift(A)) * shift(B) * C, so order matters; a document bundles (adds up) the vectors of its
n-grams, and a language prototype bundles the unit vectors of its documents. The prediction is the
language whose prototype has the largest cosine with the document.

Letters are case-folded code points for which `str.isalpha` holds; every run of other characters
counts as one gap, which has a vector of its own and stands at both ends of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import out_schema, raw, slices, with_text

DIMENSIONS = 512
ORDER = 3
SEED = 977
UNKNOWN = "und"
# Prototypes are brought together and broadcast; a table with more languages than this is refused.
MAX_LANGUAGES = 4096
# Code points of a text handled at once; counts of a longer text are added up over pieces, with the letters before a cut carried over.
PIECE = 1 << 19
_BMP = 0x10000
_letters: dict[str, np.ndarray] = {}


def _fold_table() -> np.ndarray:
    """For code points below 0x10000: the folded letter, or 0 for a gap."""
    if "fold" not in _letters:
        table = np.zeros(_BMP, np.int64)
        for point in range(_BMP):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _letters["fold"] = table
    return _letters["fold"]


def fold(points: np.ndarray) -> np.ndarray:
    """Case-folded letters of code points, 0 for all else."""
    table = _fold_table()
    high = points >= _BMP
    out = table[np.where(high, 0, points)]
    for point in np.unique(points[high]):
        char = chr(point)
        out[points == point] = ord(char.lower()) if char.isalpha() and len(char.lower()) == 1 else 0
    return out


def letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """One row of +1 and -1 per letter, made from the letter and SEED alone."""
    return np.stack([np.random.default_rng([SEED, int(x)]).choice(np.array([-1, 1], np.int8), dimensions) for x in letters])


class Binder:
    """Vectors of n-grams; keeps the vectors of letters met so far."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.known: dict[int, np.ndarray] = {}

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """Bound vectors of n-grams given as rows of letters."""
        letters, place = np.unique(grams, return_inverse=True)
        if len(self.known) > 20_000:
            self.known.clear()
        for x in letters:
            if int(x) not in self.known:
                self.known[int(x)] = letter_vectors(np.array([x]), self.dimensions)[0]
        table = np.stack([self.known[int(x)] for x in letters])
        place = place.reshape(grams.shape)
        bound = np.ones((len(grams), self.dimensions), np.int8)
        for at in range(ORDER):
            bound *= np.roll(table, ORDER - 1 - at, axis=1)[place[:, at]]
        return bound


def profiles(column: pa.Array, binder: Binder) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors of all rows, and whether a row has any letter."""
    data, offsets = raw(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    out = np.zeros((len(offsets) - 1, binder.dimensions), np.float32)
    seen = np.zeros(len(offsets) - 1, bool)
    # Each row is laid out as gap, text, gap; runs of gaps become one.
    carried = np.zeros(0, np.int64)
    for first, last, low, high in _pieces(chars):
        letters = fold(points[low:high])
        rows = np.repeat(np.arange(first, last), np.minimum(chars[first + 1 : last + 1], high) - np.maximum(chars[first:last], low))
        if low == chars[first]:
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            letters = np.insert(letters, starts, 0)
            rows = np.insert(rows, starts, rows[starts])
        else:
            # A piece of a long row goes on from the last two letters or gaps of the piece before.
            letters, rows = np.concatenate([carried, letters]), np.full(len(carried) + len(letters), first)
        if high == chars[last]:
            ends = np.flatnonzero(np.diff(rows, append=-1)) + 1
            letters, rows = np.insert(letters, ends, 0), np.insert(rows, ends, rows[ends - 1])
        keep = np.ones(len(letters), bool)
        keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (rows[1:] != rows[:-1])
        letters, rows = letters[keep], rows[keep]
        carried = letters[-2:]
        if not len(letters):
            continue
        alphabet, place = np.unique(letters, return_inverse=True)
        size = len(alphabet)
        same = rows[2:] == rows[:-2]
        gram = ((place[:-2] * size + place[1:-1]) * size + place[2:])[same]
        at = rows[1:-1][same]
        whole = letters[1:-1][same] != 0
        gram, at = gram[whole], at[whole]
        if not len(gram):
            continue
        kinds, gram = np.unique(gram, return_inverse=True) if size > 100 else _ranked(gram, size**3)
        parts = np.stack([alphabet[kinds // (size * size)], alphabet[kinds // size % size], alphabet[kinds % size]], axis=1)
        vectors = binder.vectors(parts)
        width = last - first
        counts = np.bincount((at - first) * len(kinds) + gram, minlength=width * len(kinds)).reshape(width, len(kinds)).astype(np.float32)
        for low_kind in range(0, len(kinds), 4096):
            out[first:last] += counts[:, low_kind : low_kind + 4096] @ vectors[low_kind : low_kind + 4096].astype(np.float32)
        seen[np.unique(at)] = True
    return out, seen


def _ranked(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse for values below a small size."""
    there = np.bincount(values, minlength=size) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def _pieces(chars: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Groups of rows, and of code points, of at most PIECE points; long rows are split."""
    rows, first = len(chars) - 1, 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(chars, chars[first] + PIECE, side="right")) - 1)
        last = min(last, first + 512)
        if chars[last] - chars[first] <= PIECE:
            if chars[last] > chars[first]:
                yield first, last, int(chars[first]), int(chars[last])
        else:
            for low in range(int(chars[first]), int(chars[last]), PIECE):
                yield first, last, low, min(low + PIECE, int(chars[last]))
        first = last


def fit_prototypes(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype per language from all rows with a language and a letter.

    Each task adds up its own rows, so one row per language and task is shuffled however common a
    language is. Whole numbers are added (vectors scaled to 2**20), so the sums do not depend on order.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binder, sums = Binder(dimensions), {}
        for batch in slices(batches):
            vectors, seen = profiles(batch.column(0), binder)
            norms = np.linalg.norm(vectors, axis=1)
            usable = seen & (norms > 0)
            units = np.zeros(vectors.shape, np.int64)
            units[usable] = np.rint(vectors[usable] / norms[usable, None] * (1 << 20))
            langs = np.array(batch.column(1).to_pylist(), object)
            for name in {x for x in langs if x is not None}:
                own = units[(langs == name) & usable].sum(axis=0)
                sums[name] = sums.get(name, 0) + own
        names = sorted(sums)
        values = [sums[name].astype("<i8").tobytes() for name in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], names=["lang", "sums"])

    def add(key: tuple[pa.Scalar, ...], tables: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in tables.column("sums"))
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "sums": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    rows = df.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    partial = rows.mapInArrow(bundle, "lang string, sums binary")
    found = partial.groupBy("lang").applyInArrow(add, "lang string, sums binary").take(MAX_LANGUAGES + 1)
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for row in sorted(found, key=lambda row: row.lang):
        total = np.frombuffer(bytes(row.sums), "<i8").astype(np.float64)
        norm = np.linalg.norm(total)
        if norm:
            out[row.lang] = (total / norm).astype(np.float32)
    return out


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with lang_pred, score (the cosine, from 0 to 1), has_letter and margin for every row of `df`.

    margin is by how much the cosine exceeds that of the second language, or the cosine itself where there is only one.

    NULL texts, texts without a letter and an empty set of prototypes give `und` and 0. At equal cosine
    the language first in the alphabet is taken. Repeated rows are judged one by one. Columns of `keep`
    named lang_pred, score, has_letter or margin are replaced.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score", "has_letter", "margin")]
    names = sorted(prototypes)
    dimensions = len(next(iter(prototypes.values()))) if names else DIMENSIONS
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((1, dimensions), np.float32)
    shared = df.sparkSession.sparkContext.broadcast((np.array([*names, UNKNOWN], object), matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, known = shared.value
        binder = Binder(known.shape[1])
        for batch in slices(batches, text):
            vectors, seen = profiles(batch.column(batch.schema.names.index(text)), binder)
            norms = np.linalg.norm(vectors, axis=1)
            usable = seen & (norms > 0) & (len(labels) > 1)
            cosines = (vectors @ known.T) / np.where(norms > 0, norms, 1)[:, None]
            best = np.where(usable, cosines.argmax(axis=1), len(labels) - 1)
            score = np.where(usable, np.clip(cosines.max(axis=1), 0, 1), 0).astype(np.float64)
            second = np.partition(cosines, -2, axis=1)[:, -2] if cosines.shape[1] > 1 else np.zeros(len(cosines))
            margin = np.where(usable, cosines.max(axis=1) - second, 0).astype(np.float64)
            arrays = [*batch.columns[: len(keep)], pa.array(labels[best], pa.string()), pa.array(score), pa.array(seen), pa.array(margin)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score", "has_letter", "margin"])

    return df.select(*with_text(keep, text)).mapInArrow(run, out_schema(df, keep, "lang_pred string, score double, has_letter boolean, margin double"))
