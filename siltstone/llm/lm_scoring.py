"""Language-model scoring: an interpolated modified Kneser-Ney bigram model counted in Spark.

Counting: tasks reduce their texts to distinct hashed words and word pairs with counts, blocks of these
are dealt to shards by hash, and each shard merges its blocks into sorted hash arrays in the shared
folder. Pairs are dealt by their first word, except that pairs of very common first words, of which
there are at most HOT times as many as shards, are dealt by their second word.

Scoring: workers map the arrays into memory and look up the words and pairs of a slice of documents in
sorted order. Nothing of the model passes through the driver but a few totals.

The first word of a text follows a begin mark, which is not counted as a token; each text ends with one
end token. All sums of counts are whole numbers, so a repeated task writes the same files.
"""

from __future__ import annotations

import io
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path
from .arrays import mix, pair, slices, words

BEGIN, END = np.uint64(0x0B0B0B0B0B0B0B0B), np.uint64(0x0E0E0E0E0E0E0E0E)
# Words or pairs a task gathers before it reduces them to a block.
GATHERED = 3_000_000
HOT = 4
SCORED_BYTES = 8 << 20


def local_folder(path: str) -> str:
    """The mounted folder of a shared path; arrays can be memory-mapped only from a mounted file system."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the language model needs a mounted shared folder, not {parts.scheme}://")
    return parts.path


def token_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of every row followed by END, and bounds."""
    hashes, bounds = words(column)
    tokens = np.insert(hashes, bounds[1:], END)
    return tokens, bounds + np.arange(len(bounds))


def before(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each token, BEGIN at the start of a row."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[bounds[:-1]] = BEGIN
    return out


def _block(**columns: np.ndarray | int) -> pa.RecordBatch:
    """One row with numbers as they are and arrays as bytes."""
    return pa.RecordBatch.from_pylist([{k: v.tobytes() if isinstance(v, np.ndarray) else int(v) for k, v in columns.items()}])


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts (one column or several)."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts, axis=0)


def _write(path: str, array: np.ndarray) -> None:
    """A file that is there whole or not at all, also when a task runs twice."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    held = io.BytesIO()
    np.save(held, array)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        out.write(held.getbuffer())
    os.replace(part, path)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """(tokens, tokens before) of texts, in lists of about GATHERED tokens."""
    held, size = [], 0
    for batch in slices(batches):
        tokens, bounds = token_stream(batch.column(0))
        held.append((tokens, before(tokens, bounds)))
        size += len(tokens)
        if size >= GATHERED:
            yield held
            held, size = [], 0
    if held:
        yield held


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches):
            tokens = np.concatenate([t for t, _ in held] + [np.full(sum((b == BEGIN).sum() for _, b in held), BEGIN)])
            keys, counts = np.unique(tokens, return_counts=True)
            to = keys % np.uint64(shards)
            for shard in np.unique(to):
                own = to == shard
                yield _block(shard=shard, keys=keys[own], counts=counts[own].astype(np.uint32))

    return run


def _merge_words(folder: str, shards: int):
    """Write a shard's words and counts; return totals and the most common words."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _summed(_joined(table, "keys", np.uint64), _joined(table, "counts", np.uint32))
        shard = key[0].as_py()
        _write(f"{folder}/word_keys_{shard}.npy", keys)
        _write(f"{folder}/word_counts_{shard}.npy", counts)
        token = keys != BEGIN
        top = np.argsort(-counts, kind="stable")[: HOT * shards]
        return pa.Table.from_batches(
            [_block(tokens=counts[token].sum(), types=token.sum(), hot_keys=keys[top], hot_counts=counts[top])]
        )

    return run


def _count_pairs(shards: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches):
            second = np.concatenate([t for t, _ in held])
            first = np.concatenate([b for _, b in held])
            _, at, counts = np.unique(pair(first, second), return_index=True, return_counts=True)
            first, second = first[at], second[at]
            to = np.where(np.isin(first, hot), mix(second), first) % np.uint64(shards)
            order = np.lexsort((first, to))
            first, second, counts, to = first[order], second[order], counts[order].astype(np.uint32), to[order]
            edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]]))
            for low, high in zip(edges[:-1], edges[1:]):
                starts = np.flatnonzero(np.concatenate([[True], first[low + 1 : high] != first[low : high - 1]]))
                runs = np.diff(np.append(starts, high - low)).astype(np.uint32)
                yield _block(shard=to[low], first=first[low:high][starts], runs=runs, second=second[low:high], counts=counts[low:high])

    return run


def _merge_pairs(folder: str, shards: int):
    """Write a shard's pairs; return per word shard how often words end or begin distinct pairs.

    A block (shard, keys, values) has per word: pairs that end in it, and pairs that begin with it and
    were seen once, twice, more often. One more block, at shard -1, has how many pairs were seen one to
    four times.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        first = np.repeat(_joined(table, "first", np.uint64), _joined(table, "runs", np.uint32))
        second, counts = _joined(table, "second", np.uint64), _joined(table, "counts", np.uint32)
        hashed = pair(first, second)
        order = np.argsort(hashed, kind="stable")
        hashed = hashed[order]
        starts = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]]))
        counts = np.add.reduceat(counts[order].astype(np.int64), starts)
        first, second = first[order][starts], second[order][starts]
        shard = key[0].as_py()
        _write(f"{folder}/pair_keys_{shard}.npy", hashed[starts])
        _write(f"{folder}/pair_counts_{shard}.npy", counts if len(counts) and counts.max() >= 1 << 32 else counts.astype(np.uint32))
        ends, n_ends = np.unique(second, return_counts=True)
        seen = np.zeros((len(counts), 4), np.uint32)
        seen[np.arange(len(counts)), np.minimum(counts, 3)] = 1
        begins, n_begins = _summed(first, seen)
        values = np.zeros((len(ends), 4), np.uint32)
        values[:, 0] = n_ends
        keys, values = _summed(np.concatenate([ends, begins]), np.concatenate([values, n_begins]))
        values = values.astype(np.uint32)
        to = keys % np.uint64(shards)
        out = [_block(shard=s, keys=keys[to == s], values=values[to == s]) for s in np.unique(to)]
        out.append(_block(shard=-1, keys=np.zeros(0, np.uint64), values=np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.uint64)))
        return pa.Table.from_batches(out)

    return run


def _merge_histories(folder: str):
    """Write, beside a shard's words, their four pair numbers; return how many words end one to four pairs.

    The row of shard -1 has the same numbers for the counts of pairs.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        if shard == -1:
            found = _joined(table, "values", np.uint64).reshape(-1, 4).sum(axis=0)
            return pa.table({"shard": pa.array([-1], pa.int64()), "seen": pa.array([found.astype(np.int64).tolist()], pa.list_(pa.int64()))})
        keys, values = _summed(_joined(table, "keys", np.uint64), _joined(table, "values", np.uint32).reshape(-1, 4))
        known = np.load(f"{folder}/word_keys_{shard}.npy", mmap_mode="r")
        placed = np.zeros((len(known), 4), np.int64)
        placed[np.searchsorted(known, keys)] = values
        _write(f"{folder}/word_pairs_{shard}.npy", placed)
        ends = placed[:, 0]
        found = [*np.bincount(np.minimum(ends, 5), minlength=6)[1:5], (ends > 2).sum(), ends.sum()]
        return pa.table({"shard": pa.array([shard], pa.int64()), "seen": pa.array([[int(x) for x in found]], pa.list_(pa.int64()))})

    return run


def discounts(seen: list[int]) -> tuple[float, float, float]:
    """Modified discounts for counts of one, two, and three or more, from how often counts one to four occur.

    Where a number needed is zero, or the formula leaves the range above 0 up to the count, a discount is
    half its count, so no word is ever impossible.
    """
    n1, n2, n3, n4 = (float(x) for x in seen[:4])
    share = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = [k - (k + 1) * share * more / own if own and more else 0.0 for k, own, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(d if 0 < d <= k else k / 2 for k, d in enumerate(found, 1))


@dataclass(frozen=True)
class Model:
    """Totals of a model and the folder its arrays lie in."""

    folder: str
    shards: int
    tokens: int
    types: int
    hot: tuple[int, ...]
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pairs: int
    # Words that end one, two, and more pairs.
    ends: tuple[int, int, int]


def train(df: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count the model over all rows of `df`; NULL and empty texts count as their end token.

    `shards` is spark.sql.shuffle.partitions unless given: as many files of each kind are written.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = local_folder(scratch_path(spark, "lm"))
    texts = df.select(F.col(text).alias("text"))
    counted = texts.mapInArrow(_count_words(shards), "shard long, keys binary, counts binary")
    merged = counted.groupBy("shard").applyInArrow(_merge_words(folder, shards), "tokens long, types long, hot_keys binary, hot_counts binary")
    tokens, types, candidates = 0, 0, []
    for row in merged.toLocalIterator():
        tokens, types = tokens + row.tokens, types + row.types
        candidates += zip(np.frombuffer(bytes(row.hot_counts), np.int64).tolist(), np.frombuffer(bytes(row.hot_keys), np.uint64).tolist())
        # Only words that can still be among the HOT x shards most common ones are kept.
        candidates = sorted(candidates, reverse=True)[: HOT * shards]
    hot = tuple(sorted(k for n, k in candidates if n * HOT * shards > tokens))
    paired = texts.mapInArrow(
        _count_pairs(shards, np.array(hot, np.uint64)), "shard long, first binary, runs binary, second binary, counts binary"
    )
    histories = paired.groupBy("shard").applyInArrow(_merge_pairs(folder, shards), "shard long, keys binary, values binary")
    rows = histories.groupBy("shard").applyInArrow(_merge_histories(folder), "shard long, seen array<long>").collect()
    pair_seen = next((row.seen for row in rows if row.shard == -1), [0, 0, 0, 0])
    n1, n2, n3, n4, more, pairs = np.array([row.seen for row in rows if row.shard != -1] or [[0] * 6]).sum(axis=0).tolist()
    return Model(folder, shards, tokens, types, hot, discounts(pair_seen), discounts([n1, n2, n3, n4]), pairs, (n1, n2, more))


_mapped: dict[str, np.ndarray] = {}


def _map(path: str) -> np.ndarray | None:
    """A memory-mapped array, opened once per worker; None if no row went to its shard."""
    if path not in _mapped:
        _mapped[path] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
    return _mapped[path]


def _look_up(model: Model, kind: str, values: str, keys: np.ndarray, shard: np.ndarray, width: int) -> np.ndarray:
    """Values of keys, which may repeat; zeros for keys the model lacks."""
    out = np.zeros((len(keys), width), np.int64)
    order = np.lexsort((keys, shard))
    keys, shard = keys[order], shard[order]
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(keys) else []
    for low, high in zip(edges[:-1], edges[1:]):
        known = _map(f"{model.folder}/{kind}_keys_{shard[low]}.npy")
        if known is None or not len(known):
            continue
        place = np.minimum(np.searchsorted(known, keys[low:high]), len(known) - 1)
        there = known[place] == keys[low:high]
        column = 0
        for name in values.split():
            held = _map(f"{model.folder}/{name}_{shard[low]}.npy")
            if held is not None:
                found = held[place[there]].reshape(there.sum(), -1)
                out[order[low:high][there], column : column + found.shape[1]] = found
            column += 1
    return out


def log_probabilities(model: Model, tokens: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each token after the one before it, and the counts of the tokens."""
    kinds, at = np.unique(np.concatenate([tokens, previous]), return_inverse=True)
    facts = _look_up(model, "word", "word_counts word_pairs", kinds, kinds % np.uint64(model.shards), 5)
    own, context = facts[at[: len(tokens)]], facts[at[len(tokens) :]]
    hot = np.isin(previous, np.array(model.hot, np.uint64))
    shard = np.where(hot, mix(tokens), previous) % np.uint64(model.shards)
    seen = _look_up(model, "pair", "pair_counts", pair(previous, tokens), shard, 1)[:, 0]
    cut = np.array([0.0, *model.word_discounts])
    ends = own[:, 1]
    spare = sum(d * n for d, n in zip(model.word_discounts, model.ends))
    base = 1.0 / (model.types + 1)
    word = (np.maximum(ends - cut[np.minimum(ends, 3)], 0) + spare * base) / model.pairs if model.pairs else np.full(len(tokens), base)
    cut = np.array([0.0, *model.pair_discounts])
    total = context[:, 0]
    left = context[:, 2:5] @ np.array(model.pair_discounts)
    share = (np.maximum(seen - cut[np.minimum(seen, 3)], 0) + left * word) / np.maximum(total, 1)
    return np.log10(np.where(total > 0, share, word)), own[:, 0]


SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with n_tokens, n_known, train_tokens, base_score and score for every row.

    score: log10 probability of the whole text; base_score: the same under the add-one word model.
    NULL and empty texts consist of their end token. Without training rows every token has 1 / (V + 1) = 1. Rows are scored
    one by one, so repeated rows and texts score alike. Long texts are read in slices. An empty table gives no row. Columns of
    `keep` called like the new ones are replaced.
    """
    keep = [c for c in keep if c not in SCORES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SCORED_BYTES):
            tokens, bounds = token_stream(batch.column(len(keep)))
            logs, counts = log_probabilities(model, tokens, before(tokens, bounds))
            base = np.log10((counts + 1) / (model.tokens + model.types + 1))
            sums = [np.add.reduceat(x, bounds[:-1]) for x in ((counts > 0).astype(np.int64), base, logs)]
            arrays = [*batch.columns[: len(keep)], pa.array(np.diff(bounds)), pa.array(sums[0])]
            arrays += [pa.array(np.full(batch.num_rows, model.tokens)), pa.array(sums[1]), pa.array(sums[2])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    numbers = ["n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double"]
    return df.select(*keep, F.col(text).alias("text")).mapInArrow(run, ", ".join([*kinds, *numbers]))


def score_with_corpus(df: DataFrame, usable: Column, keep: list[str], text: str = "text") -> DataFrame:
    """Train on the rows of `df` for which `usable` holds and score all rows."""
    return score(df, train(df.where(usable), text), keep, text)
