"""Weighted acyclic automata over sequences of 64-bit labels, as numpy arrays.

A transducer reads a phrase of one to DEPTH labels and gives its count. States with the same continuations
are one state, so phrases share prefixes and endings. Counts do not stand on the arcs, where they
would keep states apart, but in one array: phrases are numbered in sorted order while the automaton is
walked (every arc adds the number of phrases that its earlier sisters lead to), and the count stands
at the phrase's number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .arrays import mix, pair

DEPTH = 4
# What a transducer is stored as, one Spark column of bytes each.
FIELDS = ("labels", "arc_label", "arc_to", "arcs", "final", "levels", "weights")
COLUMNS = ", ".join(f"{name} binary" for name in FIELDS)
_FINAL, _OPEN = np.uint64(0x51ED270B7F4A7C15), np.uint64(0x2545F4914F6CDD1D)


def sort_keys(paths: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Keys for sorting rows of label places (0 for none, then 1 to size): one array if they fit, else two."""
    width = max(1, int(size).bit_length())
    columns = paths.astype(np.uint64).T
    halves = [(columns[at] << np.uint64(width)) | columns[at + 1] for at in range(0, DEPTH, 2)]
    return (halves[0] << np.uint64(2 * width) | halves[1],) if 4 * width <= 64 else tuple(halves)


def summed(paths: np.ndarray, size: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct paths in sorted order and the sums of their weights."""
    keys = sort_keys(paths, size)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    differ = np.zeros(max(len(order) - 1, 0), bool)
    for key in keys:
        key = key[order]
        differ |= key[1:] != key[:-1]
    if not len(order):
        return paths, weights
    starts = np.concatenate([[0], np.flatnonzero(differ) + 1])
    return paths[order[starts]], np.add.reduceat(weights[order], starts)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(kind).max))


@dataclass
class Transducer:
    """labels: sorted; arcs of a state lie together, sorted by label; `levels` has the states known after each depth.

    `arcs` has the number of arcs of each state. A state's arcs lead to states of smaller number, the last state is the start.
    """

    labels: np.ndarray
    arc_label: np.ndarray
    arc_to: np.ndarray
    arcs: np.ndarray
    final: np.ndarray
    levels: np.ndarray
    weights: np.ndarray

    @staticmethod
    def build(paths: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Transducer:
        """From distinct sorted paths, rows of places in `labels` from 1, with 0 after a path's end.

        Rows come in sorted order, so a state has all its arcs when the next row leaves its prefix. It is then
        looked up in the register of finished states by its ending and arcs, and taken from there if
        it is known. This is done for all prefixes of one depth at once, the deepest first.
        """
        used, paths = np.unique(paths, return_inverse=True)
        paths = paths.reshape(-1, DEPTH).astype(np.int64)
        if not len(used) or used[0] != 0:
            used, paths = np.concatenate([[0], used]), paths + 1
        own = labels[used[1:] - 1]
        rows = len(paths)
        lengths = (paths > 0).sum(axis=1)
        changed = np.zeros((rows, DEPTH + 1), bool)
        changed[:1] = True
        if rows > 1:
            changed[1:, 1:] = np.logical_or.accumulate(paths[1:] != paths[:-1], axis=1)
        register, known, levels = np.zeros(0, np.uint64), 0, []
        arc_label, arc_to, arcs, finals = [], [], [], []
        below = None
        for depth in range(DEPTH, -1, -1):
            here = lengths >= depth
            at = np.flatnonzero(changed[:, depth] & here)
            ends = lengths[at] == depth
            signature = np.where(ends, _FINAL, _OPEN)
            counts = np.zeros(len(at), np.int64)
            if below is not None and len(below[0]):
                # Children in row order; the node above a child is the last one that began at or before its row.
                child_rows, child_states = below
                owner = np.searchsorted(at, child_rows, side="right") - 1
                label = paths[child_rows, depth]
                counts = np.bincount(owner, minlength=len(at))
                sums = np.zeros(len(at), np.uint64)
                firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                sums[owner[firsts]] = np.add.reduceat(pair(label.astype(np.uint64), child_states.astype(np.uint64)), firsts)
                signature = signature ^ mix(sums)
            kinds, first, place = np.unique(signature, return_index=True, return_inverse=True)
            order = np.argsort(register, kind="stable")
            found = np.searchsorted(register[order], kinds) if known else np.zeros(len(kinds), np.int64)
            old = np.zeros(len(kinds), bool)
            if known:
                old = register[order[np.minimum(found, known - 1)]] == kinds
            states = np.empty(len(kinds), np.int64)
            states[old] = order[found[old]]
            states[~old] = known + np.arange((~old).sum())
            fresh = first[~old]
            if len(fresh):
                starts = np.cumsum(counts) - counts
                sizes = counts[fresh]
                if below is not None and sizes.sum():
                    offsets = np.repeat(starts[fresh] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    arc_label.append(label[offsets] - 1)
                    arc_to.append(child_states[offsets])
                arcs.append(sizes)
                finals.append(ends[fresh])
                register = np.concatenate([register, kinds[~old]])
                known += len(fresh)
            levels.append(known)
            below = (at, states[place])
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (arc_label, arc_to, arcs, finals)]
        return Transducer(own, *joined, np.array(levels, np.int64), np.asarray(weights, np.int64))

    def _counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First arc of each state, phrases from each state on, and phrases of a state before each arc's."""
        first = np.concatenate([[0], np.cumsum(self.arcs)]).astype(np.int64)
        total = np.zeros(len(self.arcs), np.int64)
        skip = np.zeros(len(self.arc_to), np.int64)
        low = 0
        for high in self.levels:
            if high > low:
                a, b = first[low], first[high]
                sums = np.concatenate([[0], np.cumsum(total[self.arc_to[a:b]])])
                total[low:high] = self.final[low:high] + sums[first[low + 1 : high + 1] - a] - sums[first[low:high] - a]
                owner = np.repeat(np.arange(low, high), self.arcs[low:high])
                skip[a:b] = self.final[owner] + sums[:-1] - sums[first[owner] - a]
            low = max(low, high)
        return first, total, skip

    def paths(self) -> np.ndarray:
        """All phrases in order of their numbers, as rows of places in `labels` from 1, 0 after the end."""
        out = np.zeros((len(self.weights), DEPTH), np.int64)
        if not len(out):
            return out
        first, _, skip = self._counted()
        state, number, way = np.array([len(self.arcs) - 1]), np.zeros(1, np.int64), np.zeros((1, DEPTH), np.int64)
        for depth in range(DEPTH + 1):
            ends = self.final[state].astype(bool)
            out[number[ends]] = way[ends]
            if depth == DEPTH:
                break
            sizes = self.arcs[state]
            took = np.repeat(first[state] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            way, number = np.repeat(way, sizes, axis=0), np.repeat(number, sizes) + skip[took]
            way[:, depth] = self.arc_label[took] + 1
            state = self.arc_to[took]
        return out

    def compose(self, wanted: np.ndarray) -> np.ndarray:
        """Places in `weights` of phrases given as rows of labels (0 for none), or -1.

        The phrases, an acceptor, are walked along the arcs all together, one label of each at a time.
        """
        if not len(self.weights):
            return np.full(len(wanted), -1, np.int64)
        first, _, skip = self._counted()
        place = np.searchsorted(self.labels, wanted)
        there = np.zeros(wanted.shape, bool)
        if len(self.labels):
            there = self.labels[np.minimum(place, len(self.labels) - 1)] == wanted
        size = np.int64(len(self.labels) + 1)
        keys = np.repeat(np.arange(len(self.arcs), dtype=np.int64), self.arcs) * size + self.arc_label
        state = np.full(len(wanted), len(self.arcs) - 1, np.int64)
        number = np.zeros(len(wanted), np.int64)
        alive = np.ones(len(wanted), bool)
        for depth in range(DEPTH):
            go = alive & (wanted[:, depth] != 0)
            alive &= ~go | there[:, depth]
            go = np.flatnonzero(go & alive)
            if not len(go):
                continue
            key = state[go] * size + place[go, depth]
            arc = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            met = keys[arc] == key if len(keys) else np.zeros(len(go), bool)
            alive[go[~met]] = False
            go, arc = go[met], arc[met]
            number[go] += skip[arc]
            state[go] = self.arc_to[arc]
        alive &= self.final[state].astype(bool)
        return np.where(alive, number, -1)

    def hashes(self) -> np.ndarray:
        """All phrases as rows of labels, 0 after the end."""
        return np.concatenate([np.zeros(1, np.uint64), self.labels])[self.paths()]

    def to_bytes(self) -> dict[str, bytes]:
        """One value per field: the item size, then the numbers."""
        out = {}
        for name in FIELDS:
            values = getattr(self, name)
            values = values if name == "labels" else np.packbits(values.astype(bool)) if name == "final" else _narrow(values)
            out[name] = bytes([values.dtype.itemsize]) + values.tobytes()
        return out

    @staticmethod
    def from_bytes(held: dict[str, bytes]) -> Transducer:
        kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}
        read = {name: np.frombuffer(held[name], kinds[held[name][0]], offset=1) for name in FIELDS}
        final = np.unpackbits(read["final"])[: len(read["arcs"])]
        numbers = {name: values.astype(np.int64) for name, values in read.items() if name not in ("labels", "final")}
        return Transducer(read["labels"], numbers["arc_label"], numbers["arc_to"], numbers["arcs"], final.astype(np.int64), numbers["levels"], numbers["weights"])


def from_table(table: pa.Table) -> list[Transducer]:
    """The transducers in the rows of a table."""
    columns = {name: table.column(name).to_pylist() for name in FIELDS}
    return [Transducer.from_bytes({name: columns[name][at] for name in FIELDS}) for at in range(table.num_rows)]


def union(parts: Sequence[Transducer], least: int = 0) -> Transducer:
    """One transducer of all phrases with the sums of their weights; those below `least` go."""
    labels = np.unique(np.concatenate([p.labels for p in parts])) if parts else np.zeros(0, np.uint64)
    ways = [np.zeros((0, DEPTH), np.int64)]
    for part in parts:
        ways.append(np.concatenate([[0], np.searchsorted(labels, part.labels) + 1])[part.paths()])
    weights = np.concatenate([np.zeros(0, np.int64), *(p.weights for p in parts)])
    paths, weights = summed(np.concatenate(ways), len(labels), weights)
    kept = weights >= least
    return Transducer.build(paths[kept], labels, weights[kept])
