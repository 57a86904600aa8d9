"""Ranked lexical search by the Best Position Algorithm.

Queries come in blocks of a bounded size. A first pass counts, for the words of a block only, the documents that
hold them. In a second pass every task builds an index of a segment of its documents: for each query word a list
of documents by falling impact, with the place of each document in each list for direct access. A
query reads its lists from the top, all in step; each document met is looked up in the other lists,
which gives its score and marks its places as seen. A list's best position is the end of its unbroken run of seen
places, and no document outside the runs can score more than the impacts at the best positions add
up to. That bound falls faster than one from the places read last, as places found by direct access count.
Reading stops when the bound is strictly below the k-th best score, so equal scores are never
missed. The segments' best documents, at most k each, meet in two rounds of ranking.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .arrays import owners, raw, slices, span_hashes, spans

TOP = 50
# Query text per block, and postings per segment of the index.
BLOCK_BYTES = 4 << 20
SEGMENT_POSTINGS = 1 << 21
# Places read from every list in the first step.
STEP = 32
# Salts of the first round of ranking.
SALTS = 64

_BLANK = np.ones(256, bool)
_BLANK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and bounds per row."""
    data, offsets = raw(column)
    starts, ends = spans(data, offsets, _BLANK)
    return span_hashes(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


def _frequencies(column: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, row, tf) of the known terms, sorted by row, and the number of all terms of each row."""
    hashes, bounds = terms(column)
    lengths = np.diff(bounds)
    if not len(known):
        return *(np.zeros(0, np.int64),) * 3, lengths
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    there = known[at] == hashes
    keys, tf = np.unique(owners(bounds)[there] * len(known) + at[there], return_counts=True)
    return keys % len(known), keys // len(known), tf, lengths


def _count(known: np.ndarray):
    """Documents per term, as (term, n); term -1 has the documents with a term, -2 all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, docs, size = np.zeros(len(known), np.int64), 0, 0
        for batch in slices(batches):
            term, _, _, lengths = _frequencies(batch.column(0), known)
            found += np.bincount(term, minlength=len(known))
            docs, size = docs + int((lengths > 0).sum()), size + int(lengths.sum())
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()), pa.array([docs, size, *found[at].tolist()], pa.int64())], names=["term", "n"])

    return run


class Index:
    """Impact lists of one segment; documents are numbered in order of their ids."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, term))
        term, self.doc, self.impact = term[order], doc[order], impact[order]
        self.terms, first = np.unique(term, return_index=True)
        self.edges = np.append(first, len(term))
        self.docs = int(doc.max()) + 1 if len(doc) else 0
        # By falling impact within a list, and each posting's place there.
        self.order = np.lexsort((self.doc, -self.impact, term))
        self.place = np.empty(len(term), np.int64)
        self.place[self.order] = np.arange(len(term)) - np.repeat(first, np.diff(self.edges))

    def lists(self, wanted: np.ndarray) -> list[tuple[int, int]]:
        at = np.searchsorted(self.terms, wanted)
        return [(self.edges[i], self.edges[i + 1]) for i, t in zip(at, wanted) if i < len(self.terms) and self.terms[i] == t]

    def best(self, wanted: np.ndarray, top: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the `top` best, equal scores by document, and how many places were read."""
        lists = self.lists(wanted)
        seen = [np.zeros(high - low, bool) for low, high in lists]
        best_place = [0] * len(lists)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.zeros(self.docs, bool)
        read = 0
        while lists:
            # Sorted access: the next places of every list; steps grow, so that long lists take few of them.
            met = np.concatenate([self.doc[self.order[low + read : min(low + read + step, high)]] for low, high in lists])
            read, step = read + step, step * 2
            met = np.unique(met[~known[met]])
            known[met] = True
            total = np.zeros(len(met), np.int64)
            bound = 0
            for at, (low, high) in enumerate(lists):
                # Direct access: impacts and places of these documents in every list.
                spot = low + np.searchsorted(self.doc[low:high], met)
                there = spot < high
                there[there] = self.doc[spot[there]] == met[there]
                spot = spot[there]
                total[there] += self.impact[spot]
                seen[at][self.place[spot]] = True
                gap = seen[at][best_place[at] :]
                run = int(np.argmin(gap)) if len(gap) and not gap.all() else len(gap)
                best_place[at] += run
                # Nothing is left behind a list's end.
                bound += int(self.impact[self.order[low + best_place[at] - 1]]) if best_place[at] < high - low else 0
            docs, scores = np.concatenate([docs, met]), np.concatenate([scores, total])
            if len(docs) >= top and bound < np.partition(scores, len(scores) - top)[len(scores) - top]:
                break
            if all(read >= high - low for low, high in lists):
                break
        order = np.lexsort((docs, -scores))[:top]
        order = order[scores[order] > 0]
        return docs[order], scores[order], min(read, max((high - low for low, high in lists), default=0))


def _search(known: np.ndarray, weights: np.ndarray, queries: list[tuple[int, np.ndarray]], docs: int, size: int, top: int):
    def results(held: list[tuple], ids: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        column = pa.concat_arrays(ids)
        rank = np.empty(len(column), np.int64)
        sorted_rows = pc.sort_indices(pa.table({"id": column}), sort_keys=[("id", "ascending")]).to_numpy()
        rank[sorted_rows] = np.arange(len(column))
        term, row, impact = (np.concatenate([h[i] for h in held]) for i in range(3))
        index = Index(term, rank[row], impact)
        found = [(number, *index.best(wanted, top)[:2]) for number, wanted in queries]
        found = [x for x in found if len(x[1])]
        if found:
            number = np.concatenate([np.full(len(d), n) for n, d, _ in found])
            rows = sorted_rows[np.concatenate([d for _, d, _ in found])]
            arrays = [pa.array(number), column.take(pa.array(rows)), pa.array(np.concatenate([s for _, _, s in found]))]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "doc", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, rows, postings = [], [], 0, 0
        for batch in slices(batches):
            term, row, tf, lengths = _frequencies(batch.column(1), known)
            norm = 100 - 50 + 50 * lengths * docs // max(size, 1)
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * norm[row]))
            held.append((term, row + rows, impact))
            ids.append(batch.column(0))
            rows, postings = rows + batch.num_rows, postings + len(term)
            if postings >= SEGMENT_POSTINGS:
                yield from results(held, ids)
                held, ids, rows, postings = [], [], 0, 0
        if held:
            yield from results(held, ids)

    return run


def _blocks(items: DataFrame) -> Iterator[tuple[list[int], pa.Array]]:
    """Numbers and texts of queries, about BLOCK_BYTES at a time."""
    numbers, texts, size = [], [], 0
    for row in items.select("query", "text").toLocalIterator():
        numbers.append(row.query)
        texts.append(row.text)
        size += len(row.text.encode())
        if size >= BLOCK_BYTES:
            yield numbers, pa.array(texts, pa.string())
            numbers, texts, size = [], [], 0
    if numbers:
        yield numbers, pa.array(texts, pa.string())


def search(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item, rank, key, score): the `top` documents of `df` with the highest scores above 0 for each row of `items`.

    Terms are runs of letters and digits (ASCII, A-Z lower-cased) and of bytes beyond ASCII. With N documents that hold a term,
    L terms in all, n terms of a document, df documents that hold a term and tf times in a document, a term of the item
    adds w * (1000000000 tf div (1000 tf + 20 m)), where w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 50 + 50 n N div L.
    Equal scores rank by key.

    NULL and empty texts have no terms: such documents are never found, such items find none and have no row. Equal rows of `df`
    are documents of their own; equal rows of `items` are one item, equal ids with different texts are several, each with
    ranks of its own. NULL keys come last among equal scores. Long texts are read in slices; an empty table on either side gives no
    row. Keys may be of any type that can be sorted; other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    asked = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where(F.length("text") > 0).distinct()
    path = scratch_path(spark, "queries")
    # Numbers must stay the same when a task runs again.
    asked.withColumn("query", F.monotonically_increasing_id()).write.parquet(path)
    asked = spark.read.parquet(path)
    docs = df.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    schema = f"query long, doc {df.schema[key].dataType.simpleString()}, score long"
    found = spark.createDataFrame([], schema)
    for numbers, texts in _blocks(asked):
        hashes, bounds = terms(texts)
        queries = [(number, np.unique(hashes[low:high])) for number, low, high in zip(numbers, bounds[:-1], bounds[1:])]
        known = np.unique(hashes)
        queries = [(number, np.searchsorted(known, wanted)) for number, wanted in queries if len(wanted)]
        if not queries:
            continue
        # One row per term of the block at most comes to the driver.
        counted = docs.select("text").mapInArrow(_count(known), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {row.term: row.n for row in counted.collect()}
        n, size = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array([floor(1000 * log((2 * n + 2) / (2 * counts.get(at, 0) + 1))) for at in range(len(known))], np.int64)
        found = found.unionByName(docs.mapInArrow(_search(known, weights, queries, n, size, top), schema))
    best = found
    first = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    for by in (["query", "salt"], ["query"]):
        best = best.withColumn("salt", first) if "salt" in by else best
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = best.join(asked.select("query", "item"), "query")
    return named.select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
