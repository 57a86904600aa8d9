"""Near-duplicate documents by an LSH forest over MinHash signatures, every link confirmed on full sets.

Each of TREES trees sorts the signatures, one byte per hash function, in an order of its own: from another place on, and
round to it again. The sorted rows are scanned once. Rows whose common prefix has at least DEPTH places form a region; they
are neighbours, and all pairs in a region that agree in enough places are candidates. A region with more than REGION texts
is cut along its longer common prefixes into parts that are small enough: rows that share the longest prefix stay
together, and neighbouring parts are taken together while there is room, so depth adapts to how dense a region is at each of
its places. Instead of all pairs a part yields stars around its most typical members, which are confirmed on the full shingle
sets. A second round brings the sets to the parts whose members are in different components still, and compares there what may
yet join them. A third round does so across the parts of a region: each member that is not in the component of the region's
most typical text by then meets all the others, in blocks. Components are taken over the confirmed links.

A pair of similarity 0.8 shares a region in at least one tree but for one chance in twenty million
((1 - 0.8**4)**32), and a pair's signatures agree in CUT places but for about one in a million.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir
from .arrays import mix, owners, pair, slices, words
from .components import components

TREES = 32
DEPTH = 4
HASHES = TREES * DEPTH
REGION = 2048
# Signatures that agree in this many places belong to linked texts in nearly all cases.
SURE = 110
_SEEDS = np.random.default_rng(8831).integers(1, 1 << 63, (2, HASHES), dtype=np.uint64)
# Rows that a scan gives: a candidate pair, a member with a close neighbour, a member of a divided region, a part's most typical member.
PAIR, CLOSE, DIVIDED, TYPICAL = range(4)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of all rows, sorted within a row, and bounds.

    A row with fewer than `size` words has its whole sequence as one shingle, one without words none.
    """
    hashes, bounds = words(column)
    rows = len(bounds) - 1
    counts = np.diff(bounds)
    owner = owners(bounds)
    if len(hashes) >= size:
        joined = hashes[: len(hashes) - size + 1]
        for step in range(1, size):
            joined = pair(joined, hashes[step : len(hashes) - size + 1 + step])
        inside = owner[size - 1 :] == owner[: len(owner) - size + 1]
        joined, at = joined[inside], owner[: len(owner) - size + 1][inside]
    else:
        joined, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.full(len(short), 0x51ED27, np.uint64) + counts[short].astype(np.uint64)
        for step in range(size - 1):
            more = counts[short] > step
            whole[more] = pair(whole[more], hashes[bounds[short[more]] + step])
        joined, at = np.concatenate([joined, whole]), np.concatenate([at, short])
    order = np.lexsort((joined, at))
    joined, at = joined[order], at[order]
    fresh = np.ones(len(joined), bool)
    fresh[1:] = (joined[1:] != joined[:-1]) | (at[1:] != at[:-1])
    joined, at = joined[fresh], at[fresh]
    return joined, np.searchsorted(at, np.arange(rows + 1))


def set_digests(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 16-byte digest of each set; None for an empty one."""
    full = np.diff(bounds) > 0
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    if full.any():
        starts = bounds[:-1][full]
        out[full, 0] = np.add.reduceat(mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)), starts)
        out[full, 1] = np.bitwise_xor.reduceat(mix(shingles * np.uint64(0xDA942042E4DD58B5)), starts)
    return [row.tobytes() if there else None for row, there in zip(out, full)]


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For rows with a set: one byte per hash function."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), HASHES), np.uint8)
    for j in range(HASHES):
        out[:, j] = mix(np.minimum.reduceat(shingles * (_SEEDS[0, j] | np.uint64(1)) + _SEEDS[1, j], starts)).astype(np.uint8)
    return out


def _fingerprints(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, th, n_shingles, node, bytes) per row; th is the text's hash, node the digest of the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingles, bounds = shingle_sets(batch.column(1), size)
            nodes = set_digests(shingles, bounds)
            counts = np.diff(bounds)
            places = signatures(shingles, bounds)
            at = np.cumsum(counts > 0) - 1
            there = counts > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts.astype(np.int64)),
                    pa.array(nodes, pa.binary()),
                    pa.array([places[i].tobytes() if t else None for i, t in zip(at, there)], pa.binary()),
                ],
                names=["id", "th", "n_shingles", "node", "bytes"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    return rows.mapInArrow(run, f"id {kind}, th long, n_shingles long, node binary, bytes binary")


def least_agreement(percent: int) -> int:
    """Places in which signatures of a linked pair agree, but for one chance in a million."""
    share = percent / 100
    return int(HASHES * share - 5 * (HASHES * share * (1 - share)) ** 0.5)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each leaf from batches sorted by leaf; at most one leaf is held over between batches."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        leaves = table.column("leaf").to_numpy()
        edges = np.flatnonzero(leaves[1:] != leaves[:-1]) + 1
        for low, high in zip([0, *edges[:-1]], edges):
            yield table.slice(low, high - low)
        held = table.slice(edges[-1] if len(edges) else 0).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _agreements(places: np.ndarray) -> np.ndarray:
    """How many places agree, for all members of a leaf; a leaf has at most REGION members."""
    out = np.zeros((len(places), len(places)), np.uint8)
    for i in range(len(places) - 1):
        out[i, i + 1 :] = out[i + 1 :, i] = np.count_nonzero(places[i + 1 :] == places[i], axis=1)
    return out


def _covering_pairs(agree: np.ndarray, cut: int) -> list[tuple[int, int]]:
    """Pairs that tie every member with a close neighbour to a typical member close to it.

    Members that agree in SURE places are tied first, as they are almost surely linked; one without such
    a neighbour is tied to its nearest, and to a typical member within reach.
    """
    weight = agree.sum(axis=1, dtype=np.int64)
    pairs: list[tuple[int, int]] = []
    covered = np.zeros(len(agree), bool)
    for level in (max(SURE, cut), cut):
        close = agree >= level
        degree = close.sum(axis=1)
        left = ~covered & (degree > 0)
        if level == cut:
            pairs += [(int(x), int(agree[x].argmax())) for x in np.flatnonzero(left)]
        while left.any():
            pivot = int(np.lexsort((-weight, -np.where(left, degree, -1)))[0])
            near = close[pivot]
            pairs += [(pivot, int(x)) for x in np.flatnonzero(near & left)]
            met = agree[pivot] * (covered & (agree[pivot] >= cut))
            if met.any():
                pairs.append((pivot, int(met.argmax())))
            left &= ~near
            left[pivot] = False
            covered |= near
            covered[pivot] = True
    return pairs


def parts_of(order: np.ndarray, region: int) -> list[tuple[int, int]]:
    """Ranges of at most `region` rows each that sorted signatures (one region of a tree) are cut into.

    Rows are cut where their common prefix is shortest: at the first place in which any of them differ. What is too large is
    cut again further along, and neighbours that together are small enough are taken together. Signatures that are equal all
    through are cut by number.
    """
    out: list[tuple[int, int]] = []

    def cut(low: int, high: int) -> None:
        if high - low <= region:
            out.append((low, high))
            return
        # In sorted rows the first and the last differ where any do.
        differ = np.flatnonzero(order[low] != order[high - 1])
        if not len(differ):
            out.extend((at, min(at + region, high)) for at in range(low, high, region))
            return
        place = order[low:high, differ[0]]
        edges = [low, *(np.flatnonzero(place[1:] != place[:-1]) + 1 + low).tolist(), high]
        start = low
        for first, last in zip(edges[:-1], edges[1:]):
            if last - start > region:
                if first > start:
                    out.append((start, first))
                start = first
            if last - first > region:
                cut(first, last)
                start = last
        if high > start:
            out.append((start, high))

    cut(0, len(order))
    return out


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each region from batches in order of tree and signature; at most one region is held over between batches."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        tree = table.column("tree").to_numpy()
        prefix = np.frombuffer(b"".join(x.as_py() for x in table.column("turned").combine_chunks()), np.uint8).reshape(-1, HASHES)[:, :DEPTH]
        edges = np.flatnonzero((tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *edges[:-1]], edges):
            yield table.slice(low, high - low)
        held = table.slice(edges[-1] if len(edges) else 0).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _hash(*parts: bytes) -> int:
    return int.from_bytes(blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)


def _scan(cut: int, region: int):
    """Walk the sorted signatures of all trees: candidate pairs, and what later rounds need to know of regions and their parts.

    A region is whole if the scan meets all of its `n` members in one place and they are few enough; else it is divided, be
    it by `region` or by the border of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _regions(batches):
            nodes = table.column("node").to_pylist()
            order = np.frombuffer(b"".join(table.column("turned").to_pylist()), np.uint8).reshape(-1, HASHES)
            tree = str(table.column("tree")[0].as_py()).encode()
            name = _hash(tree, order[0, :DEPTH].tobytes())
            whole = table.num_rows == table.column("n")[0].as_py() and table.num_rows <= region
            kinds, leaves, first, second = [], [], [], []

            def add(kind: int, leaf: int, a: list, b: list | None = None) -> None:
                kinds.extend([kind] * len(a))
                leaves.extend([leaf] * len(a))
                first.extend(a)
                second.extend(b or [None] * len(a))

            for low, high in parts_of(order, region):
                leaf = _hash(tree, order[low].tobytes(), nodes[low])
                own = nodes[low:high]
                agree = _agreements(order[low:high])
                degree = (agree >= cut).sum(axis=1)
                pairs = _covering_pairs(agree, cut)
                add(PAIR, leaf, [own[a] for a, _ in pairs], [own[b] for _, b in pairs])
                add(CLOSE, leaf, [own[x] for x in np.flatnonzero(degree)])
                if not whole:
                    add(DIVIDED, leaf, own)
                    add(TYPICAL, leaf, [own[int(np.lexsort((-agree.sum(axis=1, dtype=np.int64), -degree))[0])]])
            arrays = [pa.array(kinds, pa.int32()), pa.array([name] * len(kinds), pa.int64()), pa.array(leaves, pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(first, pa.binary()), pa.array(second, pa.binary())], names=["kind", "region", "leaf", "a", "b"])

    return run


def _bits(sets: list[np.ndarray]) -> np.ndarray:
    """Sets as rows of bits over all their members."""
    members, place = np.unique(np.concatenate(sets), return_inverse=True)
    out, at = np.zeros((len(sets), -(-len(members) // 8)), np.uint8), 0
    for i, one in enumerate(sets):
        row = np.zeros(len(members), bool)
        row[place[at : at + len(one)]] = True
        out[i] = np.packbits(row)
        at += len(one)
    return out


def _joining_links(roots: np.ndarray, agree: np.ndarray, cut: int, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that are confirmed on the sets and join different components, the likeliest first.

    All close pairs across components are compared, but for those joined by then.
    """
    first, second = np.nonzero(np.triu(agree >= cut) & (roots[:, None] != roots[None, :]))
    if not len(first):
        return []
    order = np.argsort(-agree[first, second].astype(np.int64), kind="stable")
    first, second = first[order], second[order]
    involved, place = np.unique(np.concatenate([first, second]), return_inverse=True)
    bits, sizes = _bits([sets[i] for i in involved]), np.array([len(sets[i]) for i in involved])
    a, b = place[: len(first)], place[len(first) :]
    roots, links = roots.copy(), []
    for low in range(0, len(a), 512):
        apart = np.flatnonzero(roots[first[low : low + 512]] != roots[second[low : low + 512]]) + low
        common = np.bitwise_count(bits[a[apart]] & bits[b[apart]]).sum(axis=1, dtype=np.int64)
        for k in apart[100 * common >= percent * (sizes[a[apart]] + sizes[b[apart]] - common)]:
            i, j = int(first[k]), int(second[k])
            if roots[i] != roots[j]:
                roots[roots == roots[j]] = roots[i]
                links.append((i, j))
    return links


def _cross_links(cut: int, percent: int):
    """Per leaf: confirmed links (u, v) that join its members' components, fewer than it has members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            nodes = table.column("node").to_pylist()
            _, roots = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
            places = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(-1, HASHES)
            held = table.column("shingles").combine_chunks()
            values, offsets = held.values.to_numpy(), held.offsets.to_numpy()
            sets = [values[offsets[i] : offsets[i + 1]] for i in range(len(nodes))]
            links = _joining_links(roots, _agreements(places), cut, sets, percent)
            if links:
                ends = [pa.array([nodes[link[k]] for link in links], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    return run


def _forest(texts: DataFrame, cut: int, region: int) -> DataFrame:
    """(kind, region, leaf, a, b): what the scan of all trees gives; `texts` has a node and its signature.

    Only texts that share a region with another are sorted.
    """
    turned = F.substring(F.concat("bytes", "bytes"), F.col("tree") * DEPTH + 1, F.lit(HASHES))
    prefix = F.substring(F.concat("bytes", "bytes"), F.col("tree") * DEPTH + 1, F.lit(DEPTH))
    tree = texts.select("node", "bytes", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    at = tree.select("node", "tree", prefix.alias("prefix"))
    counted = at.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = at.join(counted, ["tree", "prefix"]).select("node", "tree", "n").checkpoint()
    ordered = met.join(texts, "node").select("tree", prefix.alias("prefix"), turned.alias("turned"), "node", "n")
    # The border of a task divides only regions that are too large anyway.
    dense = F.col("n") > region
    borders = ["tree", "prefix", F.when(dense, F.col("turned")), F.when(dense, F.col("node"))]
    ordered = ordered.repartitionByRange(*borders).drop("prefix").sortWithinPartitions("tree", "turned", "node")
    return ordered.mapInArrow(_scan(cut, region), "kind int, region long, leaf long, a binary, b binary").checkpoint()


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    held = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("left") + F.size("right")).alias("sizes"))
    return held.where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, region: int = REGION
) -> DataFrame:
    """Per row of `df`: key, n_shingles, component_id, kept.

    Rows are linked if 100 x common shingles >= `percent` x all shingles of both; shingles are `shingle`
    words, A-Z lower-cased. component_id is the smallest key that can be reached; kept is true for the
    row that bears it. Texts with the same set form one node, however often they come. Rows without a
    word are linked to nothing. Rows with a NULL key take no part: component_id NULL, kept true. Of rows
    that share a key each is a row of its own, and all rows with the smallest key are kept.

    Meant for `percent` of 80 and above, for which TREES and DEPTH are chosen.
    """
    joined = _judged(df, key, text, shingle, percent, region)
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def one_per_component(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, region: int = REGION) -> DataFrame:
    """`df` with one row of each component, the first by key and hash of the text; see `near_duplicates`.

    Rows that share a key are judged by their texts, one by one. Rows without a word or a key stay.
    """
    rows = _judged(df, key, text, shingle, percent, region).where(F.col("root").isNotNull() & F.col("id").isNotNull())
    texts = rows.groupBy("root", "id", "th").agg(F.count(F.lit(1)).alias("times"))
    best = texts.groupBy("root").agg(F.min(F.struct("id", "th")).alias("best"))
    marked = texts.join(best, "root").withColumn("stays", F.struct("id", "th") == F.col("best"))
    marked = marked.where(~F.col("stays") | (F.col("times") > 1)).select(F.col("id").alias("__key"), F.col("th").alias("__th"), "stays").checkpoint()

    hashed = df.withColumn("__text_hash", F.xxhash64(F.col(text)))
    same = (F.col(key) == F.col("__key")) & (F.col("__text_hash") == F.col("__th"))
    kept = hashed.join(marked, same, "left_anti").select(*df.columns)
    repeated = marked.where("stays")
    if repeated.isEmpty():
        return kept
    once = hashed.join(repeated, same, "left_semi").dropDuplicates([key, "__text_hash"]).select(*df.columns)
    return kept.unionByName(once)


def _judged(df: DataFrame, key: str, text: str, shingle: int, percent: int, region: int) -> DataFrame:
    """(node, id, th, n_shingles, component_id, root) per row: th is the text's hash, root a node that stands for the component."""
    spark = df.sparkSession
    shared_dir(spark)
    cut = least_agreement(percent)
    prints = _fingerprints(df, key, text, shingle).checkpoint()
    known = prints.where(F.col("id").isNotNull() & F.col("node").isNotNull())
    classes = known.groupBy("node").agg(F.min("id").alias("least_id")).checkpoint()
    # One row per different set: the row that bears the smallest key.
    own = known.select("id", "node", "bytes")
    texts = own.join(classes.withColumnRenamed("least_id", "id"), ["node", "id"]).dropDuplicates(["node"]).select("node", "bytes").checkpoint()
    scanned = _forest(texts, cut, region)
    close = scanned.where(F.col("kind") == CLOSE).select("leaf", F.col("a").alias("node"))
    split = scanned.where(F.col("kind") == DIVIDED).select("region", "leaf", F.col("a").alias("node"))
    pairs = scanned.where(F.col("kind") == PAIR).select("a", "b")
    divided = not split.isEmpty()
    if divided:
        sizes = split.groupBy("region", "leaf").agg(F.count(F.lit(1)).alias("n"))
        densest = sizes.groupBy("region").agg(F.max_by("leaf", F.struct("n", "leaf")).alias("leaf"))
        pivots = densest.join(scanned.where(F.col("kind") == TYPICAL).select("leaf", "a"), "leaf").select("region", "a").checkpoint()
        pairs = pairs.unionByName(split.join(pivots, "region").select("a", F.col("node").alias("b")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(close.select("node")).distinct().join(classes, "node")
    sets = _sets(df, needed, key, text, shingle).checkpoint()
    first = _confirm(pairs.where(F.col("a") != F.col("b")), sets, percent).checkpoint()
    roots = components(first)
    found = _rest(close, texts, roots, sets, cut, percent)
    edges = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(found).where(F.col("u") != F.col("v"))
    if not found.isEmpty():
        roots = components(edges)
    roots = roots.checkpoint()
    if divided:
        blocks = _open_blocks(split, pivots, roots, region)
        more = None if blocks is None else _across(df, blocks, texts, classes, roots, cut, key, text, shingle, percent)
        if more is not None and not more.isEmpty():
            tied = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).where(F.col("u") != F.col("v"))
            roots = components(tied.unionByName(more)).checkpoint()
    least = roots.join(classes, "node").groupBy("root").agg(F.min("least_id").alias("linked_id"))
    linked = roots.join(least, "root").select("node", "linked_id", "root")
    named = classes.join(linked, "node", "left").select(
        "node", F.coalesce("linked_id", "least_id").alias("component_id"), F.coalesce("root", "node").alias("root")
    )
    return prints.select("id", "th", "n_shingles", "node").join(named, "node", "left")


def _sets(df: DataFrame, needed: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(node, shingles) of the nodes in `needed` (node, least_id), from the texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingles, bounds = shingle_sets(batch.column(1), size)
            nodes = set_digests(shingles, bounds)
            wanted = batch.column(0).to_pylist()
            at = [i for i, (node, want) in enumerate(zip(nodes, wanted)) if node == want]
            values = [shingles[bounds[i] : bounds[i + 1]].view(np.int64) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in at], pa.binary()), pa.array(values, pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    rows = df.select(F.col(key).alias("least_id"), F.col(text).alias("text")).join(needed, "least_id").select("node", "text")
    return rows.mapInArrow(run, "node binary, shingles array<long>").dropDuplicates(["node"])


def _rest(close: DataFrame, texts: DataFrame, roots: DataFrame, sets: DataFrame, cut: int, percent: int) -> DataFrame:
    """Confirmed links between components, from the parts (leaf, node) that hold members of more than one.

    Only members with a close neighbour are given. Their sets are brought to the part and compared there, so pairs that
    fail are never made into rows.
    """
    labelled = close.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = labelled.groupBy("leaf").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("leaf")
    members = labelled.join(mixed, "leaf").join(texts, "node").select("leaf", "node", "bytes", "root")
    apart = members.repartition("leaf").sortWithinPartitions("leaf", "node").mapInArrow(_close_across(cut), "leaf long, node binary, bytes binary, root binary")
    # Sets are long, so they come only to members that are close to one of another component.
    brought = apart.checkpoint().join(sets, "node").select("leaf", "node", "bytes", "root", "shingles")
    return brought.repartition("leaf").sortWithinPartitions("leaf", "node").mapInArrow(_cross_links(cut, percent), "u binary, v binary").checkpoint()


def _open_blocks(split: DataFrame, pivots: DataFrame, roots: DataFrame, region: int) -> DataFrame | None:
    """(leaf, node) in which every open member of a divided region meets all members, or None if none is open.

    A member is open if it is not in the component of the region's pivot. Regions whose pivots are in one
    component are taken together, so that a pair which shares many of them is compared once. Open members and
    all members are dealt into blocks of half of `region`; each block of the ones meets each of the others.
    """
    known = roots.select("node", "root")
    masses = pivots.join(known.withColumnRenamed("node", "a"), "a", "left").select("region", F.coalesce("root", "a").alias("mass"))
    members = split.select("region", "node").join(masses, "region").select("mass", "node").distinct().join(known, "node", "left")
    members = members.select("mass", "node", (F.coalesce("root", "node") != F.col("mass")).alias("open")).checkpoint()
    counts = members.groupBy("mass").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("n_open")).where("n_open > 0")
    counts = counts.checkpoint()
    if counts.isEmpty():
        return None
    half = max(1, region // 2)
    dealt = members.join(counts, "mass").withColumns({"rows": F.ceil(F.col("n_open") / half), "columns": F.ceil(F.col("n") / half)})
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).alias("turn") for c in ("columns", "rows")]
    row, column = F.pmod(F.xxhash64("node"), "rows"), F.pmod(F.xxhash64("node"), "columns")
    opened = dealt.where("open").select("mass", "node", row.alias("at"), every[0]).select("node", F.xxhash64("mass", "at", "turn").alias("leaf"))
    others = dealt.select("mass", "node", column.alias("at"), every[1]).select("node", F.xxhash64("mass", "turn", "at").alias("leaf"))
    return opened.unionByName(others).distinct()


def _across(
    df: DataFrame, blocks: DataFrame, texts: DataFrame, classes: DataFrame, roots: DataFrame, cut: int, key: str, text: str, size: int, percent: int
) -> DataFrame:
    """Confirmed links between components from blocks; sets are brought only to members with a close one in another component."""
    labelled = blocks.join(texts.select("node", "bytes"), "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    dealt = labelled.select("leaf", "node", "bytes", "root").repartition("leaf").sortWithinPartitions("leaf", "node")
    close = dealt.mapInArrow(_close_across(cut), "leaf long, node binary, bytes binary, root binary").select("leaf", "node").checkpoint()
    needed = close.select("node").distinct().join(classes, "node")
    return _rest(close, texts, roots, _sets(df, needed, key, text, size).checkpoint(), cut, percent)


def _close_across(cut: int):
    """Per leaf: its members that agree often enough with one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            _, roots = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
            places = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(-1, HASHES)
            close = ((_agreements(places) >= cut) & (roots[:, None] != roots[None, :])).any(axis=1)
            if close.any():
                yield from table.select(["leaf", "node", "bytes", "root"]).filter(pa.array(close)).combine_chunks().to_batches()

    return run
