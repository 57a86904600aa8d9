"""Benchmark decontamination by templates: numbers, names and units become typed slots.

A text is read as tokens; a token is a number, a name (written with one leading capital), a unit (a word
of UNITS right after a number) or a word. Windows of WINDOW tokens are hashed with the slots' types in
place of their values and met with the windows of the benchmark by hash. Adjoining windows on the same
item form a run, and within a run the slots must be consistent: equal benchmark values stand for equal
document values and different for different. So a question with other names and numbers is found,
while the same frame around unrelated values is not. A second set of templates takes names as words
whatever their case, so that shouted or lower-cased copies are found too. A third set takes every token by
its value, so that texts of numbers, tables and short questions are found by verbatim copies.

Benchmarks are read in blocks of a bounded size, each sent to the workers as sorted hashes; documents
are scanned once per block, and no document text is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .arrays import mix, out_schema, powers, raw, slices, span_hashes, with_text

WINDOW = 8
# Part of an item with other slot values must be this long, as frames of common words recur by chance.
CHANGED = 16
# A window with slots must hold this many plain words, so that slots alone identify nothing.
LEAST_WORDS = 4
# Items of fewer tokens than WINDOW are matched as a whole; below this many they identify nothing.
# Here and in the length of a run, a Han or kana character counts as half a token, a Thai one as a quarter.
LEAST_TOKENS = 4
# Benchmark text per block, in bytes.
BLOCK_BYTES = 16 << 20
# Units of measure, money and time; fixed values.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees mph kph kmh watt watts volt volts joule joules newton newtons meter "
    "meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre centimetres"
).split()
WORD, NUMBER, NAME, UNIT = range(4)
_SLOTS = mix(np.array([11, 23, 37, 53], np.uint64))


# Classes of characters; those of scripts without blanks are tokens of their own.
LETTER, DIGIT, IDEOGRAPH, SYLLABLE = 1, 2, 3, 4
# Quarters of a word that a token of each class counts for.
_QUARTERS = np.array([0, 4, 4, 2, 1], np.int64)
# Han and kana; Thai, Lao, Myanmar, Khmer and Tai Tham.
_IDEOGRAPHS = (0x3005, 0x3007), (0x3040, 0x30FF), (0x3100, 0x312F), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D)
_SYLLABLES = (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1A20, 0x1AAF)
_APOSTROPHES = "\u2018\u2019"


@cache
def _classes() -> np.ndarray:
    """The class of each code point below 0x40000; punctuation, symbols, blanks and controls have 0."""
    out = np.full(0x40000, LETTER, np.uint8)
    for point in range(0x20000):
        kind = category(chr(point))
        if kind == "Nd":
            out[point] = DIGIT
        elif kind[0] in "PSZ" or kind == "Cc" or point in (0x200B, 0x2060, 0xFEFF):
            out[point] = 0
    out[0x20000:] = IDEOGRAPH
    for ranges, name in ((_IDEOGRAPHS, IDEOGRAPH), (_SYLLABLES, SYLLABLE)):
        for low, high in ranges:
            part = out[low : high + 1]
            part[part == LETTER] = name
    return out


def _ascii() -> tuple[np.ndarray, np.ndarray]:
    letter, digit = np.zeros(256, bool), np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123), 39, *range(128, 256)]] = True
    digit[48:58] = True
    return letter, digit


_LETTER, _DIGIT = _ascii()


def _character_classes(data: np.ndarray, code: np.ndarray) -> None:
    """Set the classes of all bytes of characters beyond ASCII."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return
    follow = [data[np.minimum(lead + k, len(data) - 1)].astype(np.uint32) & 0x3F for k in (1, 2, 3)]
    first = data[lead].astype(np.uint32)
    points = np.where(
        first < 0xE0,
        (first & 0x1F) << 6 | follow[0],
        np.where(first < 0xF0, (first & 0x0F) << 12 | follow[0] << 6 | follow[1], (first & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2]),
    )
    table = _classes()
    classes = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], np.uint8(LETTER))
    at = np.flatnonzero(data >= 0x80)
    code[at] = classes[np.maximum(np.searchsorted(lead, at, side="right") - 1, 0)]


def _units() -> np.ndarray:
    joined = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    ends = np.append(np.flatnonzero(joined == 32), len(joined))
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.sort(span_hashes(joined, starts, ends, lower=True))


@dataclass
class Tokens:
    """Tokens of a text column: kinds, value hashes, and bounds per row."""

    kinds: np.ndarray
    values: np.ndarray
    bounds: np.ndarray
    quarters: np.ndarray

    def without_names(self) -> Tokens:
        return Tokens(np.where(self.kinds == NAME, np.uint8(WORD), self.kinds), self.values, self.bounds, self.quarters)

    def without_slots(self) -> Tokens:
        return Tokens(np.zeros_like(self.kinds), self.values, self.bounds, self.quarters)

    @property
    def templates(self) -> np.ndarray:
        return np.where(self.kinds == WORD, self.values, _SLOTS[self.kinds])


def read_tokens(column: pa.Array, units: np.ndarray, lower: bool = False) -> Tokens:
    """Letters and digits form tokens of their own; a point or comma between digits belongs to a number.

    Each character of a script without blanks is a token. An apostrophe, straight or curly, belongs to a word
    between letters only.

    Value hashes are of lower-cased tokens; with `lower` the text is in lower case already.
    """
    if not lower:
        column = column.cast(pa.large_string())
        for mark in _APOSTROPHES:
            column = pc.replace_substring(column, mark, "'")
    data, offsets = raw(column)
    size = len(data)
    letter, digit = _LETTER[data], _DIGIT[data]
    if size > 2:
        digit[1:-1] |= ((data[1:-1] == 46) | (data[1:-1] == 44)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
    code = letter + 2 * digit.astype(np.uint8)
    _character_classes(data, code)
    quote = np.flatnonzero(data == 39)
    edge = np.isin(quote, offsets) | np.isin(quote + 1, offsets)
    around = [np.clip(quote + k, 0, max(size - 1, 0)) for k in (-1, 1)]
    code[quote[edge | np.logical_or.reduce([(code[k] != LETTER) | (data[k] == 39) for k in around])]] = 0
    single = np.zeros(size + 1, bool)
    single[:-1] = (code >= IDEOGRAPH) & ((data & 0xC0) != 0x80)
    previous = np.zeros(size + 1, np.uint8)
    previous[1:] = code
    previous[offsets] = 0
    starts = np.flatnonzero((code > 0) & ((code != previous[:-1]) | single[:-1]))
    after = np.zeros(size + 1, np.uint8)
    after[:-1] = code
    after[offsets] = 0
    ends = np.flatnonzero((code > 0) & ((code != after[1:]) | single[1:])) + 1
    bounds = np.searchsorted(starts, offsets)
    quarters = _QUARTERS[code[starts]]
    if lower:
        return Tokens(np.zeros(len(starts), np.uint8), span_hashes(data, starts, ends, lower=True), bounds, quarters)
    # Lower-casing leaves letters letters, so tokens of the lower-cased text stand in the same order.
    values = read_tokens(pc.utf8_lower(column), units, lower=True).values
    kinds = np.zeros(len(starts), np.uint8)
    if len(starts):
        capital = _capitals(data, starts)
        second = starts + np.where(data[starts] >= 0xC0, 2, 1)
        inside = second < ends
        again = np.zeros(len(starts), bool)
        again[inside] = _capitals(data, second[inside])
        number = code[starts] == DIGIT
        kinds[capital & ~again] = NAME
        kinds[number] = NUMBER
        place = np.minimum(np.searchsorted(units, values), len(units) - 1)
        follows = np.concatenate([[False], number[:-1]])
        follows[np.minimum(bounds[:-1], len(starts) - 1)] = False
        kinds[(units[place] == values) & follows & ~number] = UNIT
    return Tokens(kinds, values, bounds, quarters)


def _capitals(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a capital of the Latin, Greek or Cyrillic alphabet begins at a byte."""
    first = data[at]
    second = data[np.minimum(at + 1, len(data) - 1)]
    return (
        ((first >= 65) & (first <= 90))
        | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        | ((first == 0xCE) & (second >= 0x91) & (second <= 0xA9))
        | ((first == 0xD0) & (second >= 0x80) & (second <= 0xAF))
    )


def window_hashes(tokens: Tokens, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first tokens of the windows that lie in one row and hold enough words."""
    count = len(tokens.kinds)
    if count < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(tokens.bounds) - 1), np.diff(tokens.bounds))
    words = np.concatenate([[0], np.cumsum(tokens.kinds == WORD)])
    usable = (owner[size - 1 :] == owner[: count - size + 1]) & (words[size:] - words[:-size] >= min(LEAST_WORDS, size))
    up, down = powers(count + 1)
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(tokens.templates * up[:count], out=sums[1:])
    at = np.flatnonzero(usable)
    return mix((sums[at + size] - sums[at]) * down[at] + np.uint64(size)), at


@dataclass
class Block:
    """Windows of some benchmark items: sorted hashes, and items with their place for each hash."""

    ids: list[list[int]]
    kinds: list[np.ndarray]
    values: list[np.ndarray]
    windows: dict[int, dict[int, list[tuple[int, int]]]]
    units: np.ndarray
    # Sums of quarters over each item's tokens.
    sums: list[np.ndarray] = field(default_factory=list)
    # Whether every token stands for itself, so that a run is verbatim.
    exact: bool = False
    sieve: dict[int, np.ndarray] = field(default_factory=dict)


def _pattern(kinds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values with slots numbered by their first place: equal for items that differ in the values of their slots only."""
    slots = np.flatnonzero(kinds != WORD)
    out = values.copy()
    numbers: dict[tuple[int, int], int] = {}
    for at in slots.tolist():
        out[at] = numbers.setdefault((int(kinds[at]), int(values[at])), len(numbers))
    return out


def build_block(ids: list, tokens: Tokens, units: np.ndarray) -> Block:
    """Items of one template, with equal slots in equal places, share an entry, whatever the values of the slots.

    So a benchmark made from few templates has few entries, and slots are checked once for all its items.
    """
    merged: dict[bytes, int] = {}
    block = Block([], [], [], {}, units, exact=not tokens.kinds.any())
    for i, item in enumerate(ids):
        low, high = tokens.bounds[i], tokens.bounds[i + 1]
        if tokens.quarters[low:high].sum() < 4 * LEAST_TOKENS:
            continue
        kinds, values = tokens.kinds[low:high], tokens.values[low:high]
        known = merged.setdefault(kinds.tobytes() + _pattern(kinds, values).tobytes(), len(block.ids))
        if known < len(block.ids):
            block.ids[known].append(item)
            continue
        block.ids.append([item])
        block.kinds.append(kinds)
        block.values.append(values)
        block.sums.append(np.concatenate([[0], np.cumsum(tokens.quarters[low:high])]))
        own = Tokens(kinds, values, np.array([0, len(kinds)]), tokens.quarters[low:high])
        size = min(WINDOW, len(kinds))
        hashes, at = window_hashes(own, size)
        held = block.windows.setdefault(size, defaultdict(list))
        for h, k in zip(hashes.tolist(), at.tolist()):
            held[h].append((known, k))
    for size, held in block.windows.items():
        sieve = np.zeros(1 << 20, bool)
        sieve[np.fromiter(held, np.uint64, len(held)) & np.uint64((1 << 20) - 1)] = True
        block.sieve[size] = sieve
    return block


def consistent_runs(places: list[int], size: int, item: tuple[np.ndarray, np.ndarray], doc: tuple[np.ndarray, np.ndarray], shift: int) -> Iterator[tuple[int, int, bool]]:
    """(first token, end, verbatim) of each run; `places` are sorted starts in the item, `shift` leads to the document.

    A window whose slots contradict those of its run so far begins a run of its own; a window that
    contradicts itself belongs to none.
    """
    there: dict[tuple[int, int], int] = {}
    back: dict[tuple[int, int], int] = {}
    length, reached, verbatim = 0, -1, True
    for place in places:
        for fresh in (False, True):
            if fresh or place > reached:
                if length:
                    yield reached - length, reached, verbatim
                there, back, length, reached, verbatim = {}, {}, 0, place, True
            first = max(place, reached)
            added = []
            fits = True
            for k in range(first, place + size):
                kind, value, other = int(item[0][k]), int(item[1][k]), int(doc[1][k + shift])
                if kind == WORD:
                    continue
                if there.get((kind, value), other) != other or back.get((kind, other), value) != value:
                    fits = False
                    break
                if (kind, value) not in there:
                    there[kind, value] = other
                    back[kind, other] = value
                    added.append((kind, value, other))
                verbatim &= value == other
            if fits:
                length += place + size - first
                reached = place + size
                break
            for kind, value, other in added:
                del there[kind, value], back[kind, other]
            if fresh or not length:
                there, back, length, reached, verbatim = {}, {}, 0, -1, True
                break
    if length:
        yield reached - length, reached, verbatim


def find_items(tokens: Tokens, block: Block) -> dict[int, dict[int, tuple[int, bool]]]:
    """Row to benchmark id to (tokens of the longest consistent run, whether it is verbatim)."""
    met: dict[tuple[int, int, int, int], list[int]] = defaultdict(list)
    for size, held in block.windows.items():
        hashes, at = window_hashes(tokens, size)
        passed = block.sieve[size][hashes & np.uint64((1 << 20) - 1)]
        hashes, at = hashes[passed], at[passed]
        rows = np.searchsorted(tokens.bounds, at, side="right") - 1
        for h, k, row in zip(hashes.tolist(), at.tolist(), rows.tolist()):
            for entry, place in held.get(h, ()):
                met[row, entry, k - place, size].append(place)
    found: dict[int, dict[int, tuple[int, bool]]] = defaultdict(dict)
    for (row, entry, shift, size), places in met.items():
        item, doc = (block.kinds[entry], block.values[entry]), (tokens.kinds, tokens.values)
        sums = block.sums[entry]
        for low, high, _ in consistent_runs(sorted(places), size, item, doc, shift):
            # What is verbatim is found by the templates that take every token by its value.
            verbatim = block.exact
            # A part of an item must be long enough; characters of scripts without blanks count for less than a word.
            if high - low < len(item[0]) and sums[high] - sums[low] < 4 * (WINDOW if verbatim else CHANGED):
                continue
            run = (high - low, verbatim)
            for name in block.ids[entry]:
                found[row][name] = max(found[row].get(name, (0, False)), run)
    return found


def contamination(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of `df`: the columns `keep` (only the key unless given), item_ids, matched_tokens, verbatim, contaminated.

    item_ids: sorted ids of the items of which a consistent run of at least WINDOW tokens, or CHANGED if slots
    have other values (or the whole item, if shorter) occurs; matched_tokens: length of the longest such run; verbatim: whether a
    longest run has the benchmark's own slot values. NULL and empty texts match nothing; items with a
    NULL id or text, or of fewer than LEAST_TOKENS tokens, are matched by nothing. Ids may be of any type that sorts.
    Repeated rows are judged one by one, repeated items count once. Long texts are read in slices. An empty table gives no
    row, an empty benchmark matches nothing. Columns of `keep` called like the new ones are replaced.
    """
    found = ("item_ids", "matched_tokens", "verbatim")
    kind = benchmark.schema[item].dataType
    keep = [c for c in keep or [key] if c not in (*found, "contaminated")]
    items = benchmark.where(F.col(item).isNotNull() & F.col("text").isNotNull()).select(F.col(item).alias("item"), F.col("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = df.select(*with_text(keep, text))
    for number in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        ids, texts = [r.item for r in own], [r.text for r in own]
        units = _units()
        tokens = read_tokens(pa.array(texts, pa.string()), units)
        sets = (tokens, tokens.without_names(), tokens.without_slots())
        shared = df.sparkSession.sparkContext.broadcast(tuple(build_block(ids, one, units) for one in sets))
        # The text, and what earlier blocks found, travel along until the last block.
        out = keep if number == blocks - 1 else with_text(keep, text)
        schema = out_schema(df, out, f"item_ids array<{kind.simpleString()}>, matched_tokens long, verbatim boolean")
        rows = rows.mapInArrow(_scan(shared, text, out, number > 0, to_arrow_type(kind)), schema)
    return rows.withColumn("contaminated", F.col("matched_tokens") > 0)


def _scan(shared, text: str, out: list[str], later: bool, kind: pa.DataType):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        typed, plain, exact = shared.value
        for batch in slices(batches, text):
            names = batch.schema.names
            tokens = read_tokens(batch.column(names.index(text)), typed.units)
            found = find_items(tokens, typed)
            others = find_items(tokens.without_names(), plain), find_items(tokens.without_slots(), exact)
            ids, longest, verbatim = [], [], []
            for i in range(batch.num_rows):
                runs = dict(found.get(i, {}))
                for again in others:
                    for name, run in again.get(i, {}).items():
                        runs[name] = max(runs.get(name, (0, False)), run)
                best, held = max(runs.values(), default=(0, False)), sorted(runs)
                if later:
                    before = [batch.column(names.index(c))[i].as_py() for c in ("item_ids", "matched_tokens", "verbatim")]
                    best, held = max(best, (before[1], before[2])), sorted({*held, *before[0]})
                ids.append(held)
                longest.append(best[0])
                verbatim.append(best[1])
            arrays = [batch.column(names.index(c)) for c in out]
            arrays += [pa.array(ids, pa.list_(kind)), pa.array(longest, pa.int64()), pa.array(verbatim, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*out, "item_ids", "matched_tokens", "verbatim"])

    return scan
