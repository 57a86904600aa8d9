"""Type-1 and type-2 tables kept by keyed state.

The stream is grouped by key, and what a key needs to place its next change stays in Spark's state store: for
type 1 the position of the newest change, for type 2 the positions of all changes in pages, so that a row that comes
late is put between its neighbours without reading anything else. A micro-batch then writes rows of the keys
it touched and no others: the changes that count, and the bounds of the versions that they opened, closed or took
away. The table is read off these rows by one aggregation.

State holds positions, not rows. Rows that repeat a known position change nothing; at an equal sequence a live row
wins over a delete, then the larger row hash, as in `operators.scd`.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType, TimestampType

from ..operators.changes import RESERVED
from ..operators.columns import comparable, quoted
from ..operators.scd import LIVE, TIE, _prepare, validity

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Positions of one key per page of state.
PAGE = 256
# Points and the index go in and out of state as bytes; as structs, each value of each position would be converted on its own.
BYTES = StructType([StructField("bytes", BinaryType())])
POINTS = StructType([StructField("points", ArrayType(BinaryType()))])
ROW, PLACE, DIGEST, BOUND, EMITTED, PRESENT, UNTIL, BATCH = "__row", "__place", "__digest", "__bound", "__emitted", "__present", "__until", "__batch"


def with_rocksdb(changed: DataFrame, writer: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Run a stateful stream over all that is available, its state on local disk and in its checkpoint instead of in memory."""
    spark = changed.sparkSession
    before = spark.conf.get(PROVIDER_CONF)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        query = writer(changed).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER_CONF, before)
    query.awaitTermination()


def _plain(df: DataFrame, name: str) -> Column:
    """The column as a value that state gives back as it took it: moments as microseconds."""
    return F.unix_micros(quoted(name)) if isinstance(df.schema[name].dataType, TimestampType) else quoted(name)


class _Latest(StatefulProcessor):
    """Type 1: lets a row pass if it is newer than all rows of its key so far."""

    def __init__(self, order: Sequence[str], state: StructType):
        self.order, self.state = list(order), state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.newest.get()
        best, emitted = (tuple(known[:-1]), known[-1]) if known is not None else (None, 0)
        winner = None
        for row in rows:
            at = tuple(row[c] for c in self.order)
            if best is None or at > best:
                best, winner = at, row
        if winner is not None:
            self.newest.update((*best, emitted + 1))
            yield Row(**{**winner.asDict(), EMITTED: emitted + 1})


class _Points:
    """The positions of one key in order, kept in pages of state and read as they are needed.

    A point is (sequence..., live, tie, digest, bound). The index has the first sequence of every page.
    """

    def __init__(self, index, pages, width: int):
        self.index_state, self.page_state, self.width = index, pages, width
        known = index.get()
        self.ids, self.firsts, self.emitted = pickle.loads(known[0]) if known is not None else ([], [], 0)
        self.held: dict[int, list[tuple]] = {}
        self.changed: set[int] = set()

    def _page(self, at: int) -> list[tuple]:
        number = self.ids[at]
        if number not in self.held:
            self.held[number] = [pickle.loads(p) for p in self.page_state.getValue((number,))[0]]
        return self.held[number]

    def _spot(self, sequence: tuple) -> tuple[int, int]:
        """Page and place of a sequence, or where it would stand."""
        if not self.ids:
            self.ids, self.firsts, self.held[0] = [0], [sequence], []
        at = max(bisect_right(self.firsts, sequence) - 1, 0)
        # A sequence sorts before the point that begins with it.
        return at, bisect_left(self._page(at), sequence)

    def put(self, point: tuple) -> bool:
        """Take in a point; False if its position is known with an equal or better row."""
        sequence = point[: self.width]
        at, place = self._spot(sequence)
        page = self._page(at)
        if place < len(page) and page[place][: self.width] == sequence:
            if page[place][self.width : self.width + 2] >= point[self.width : self.width + 2]:
                return False
            page[place] = point
        else:
            page.insert(place, point)
        self.firsts[at] = page[0][: self.width]
        self.changed.add(self.ids[at])
        if len(page) > PAGE:
            half, number = len(page) // 2, max(self.ids) + 1
            self.held[number], self.held[self.ids[at]] = page[half:], page[:half]
            self.ids.insert(at + 1, number)
            self.firsts.insert(at + 1, page[half][: self.width])
            self.changed.add(number)
        return True

    def from_spot(self, at: int, place: int, step: int) -> Iterator[tuple]:
        """Points from a place on, forwards or backwards."""
        while 0 <= at < len(self.ids):
            page = self._page(at)
            while 0 <= place < len(page):
                yield page[place]
                place += step
            at += step
            place = 0 if step > 0 else (len(self._page(at)) - 1 if at >= 0 else -1)

    def around(self, sequence: tuple) -> tuple[Iterator[tuple], Iterator[tuple]]:
        """Points before a sequence, latest first, and points from it on."""
        at, place = self._spot(sequence)
        return self.from_spot(at, place - 1, -1), self.from_spot(at, place, 1)

    def store(self) -> None:
        for number in self.changed:
            self.page_state.updateValue((number,), ([pickle.dumps(p) for p in self.held[number]],))
        self.index_state.update((pickle.dumps((self.ids, self.firsts, self.emitted)),))


class _Versions(StatefulProcessor):
    """Type 2: lets the changes that count pass, and gives the bounds of all versions that they touch."""

    def __init__(self, keys: Sequence[str], sequence: Sequence[str], tracked: bool):
        self.keys, self.sequence, self.tracked = list(keys), list(sequence), tracked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.index = handle.getValueState("index", BYTES)
        self.pages = handle.getMapState("pages", StructType([StructField("id", LongType())]), POINTS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        width = len(self.sequence)
        points = _Points(self.index, self.pages, width)

        def opens(point: tuple, before: tuple | None) -> bool:
            """Whether a point bounds versions: it differs from the point before it."""
            same = before is not None and self.tracked and (before[width], before[width + 2]) == (point[width], point[width + 2])
            return not same

        out = Row(*self.keys, *self.sequence, ROW, EMITTED, PRESENT, UNTIL)
        # Of rows that come at one position in a batch the best goes out, and once.
        touched = {}
        for row in rows:
            point = tuple(row[c] for c in (*self.sequence, LIVE, TIE, DIGEST, BOUND))
            if points.put(point):
                touched[point[:width]] = row[ROW]
        # A new point may bound the version before it, and give the point after it another neighbour.
        asked = {}
        for sequence in touched:
            before, after = points.around(sequence)
            asked[sequence] = None
            next(after, None)
            following = next(after, None)
            if following is not None:
                asked[following[:width]] = None
            earlier = next(before, None)
            while earlier is not None:
                previous = next(before, None)
                if opens(earlier, previous):
                    asked[earlier[:width]] = None
                    break
                earlier = previous
        for sequence in asked:
            before, after = points.around(sequence)
            own = next(after)
            present = own[width] and opens(own, next(before, None))
            until, last = None, own
            if present:
                for point in after:
                    if opens(point, last):
                        until = point[-1]
                        break
                    last = point
            points.emitted += 1
            yield out(*key, *sequence, touched.get(sequence), points.emitted, present, until)
        if touched:
            points.store()


@dataclass
class KeyedScd:
    """A type-1 or type-2 table below `path`, fed by a stream of changes; parameters as in `operators.scd`.

    Rows with NULL in key or sequence are left to `operators.scd.unusable_changes`. Columns must be of types that Arrow carries.
    """

    path: str
    keys: Sequence[str]
    sequence_by: Sequence[str]
    scd_type: int = 1
    delete_when: str | None = None
    except_cols: Sequence[str] = field(default_factory=lambda: list(RESERVED))
    track: Sequence[str] | None = None
    valid_from: str | None = None
    at: Column | None = None
    tie_break: Sequence[str] | None = None

    def __post_init__(self):
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")

    def changes(self, stream: DataFrame) -> DataFrame:
        """The rows to store for a stream of changes."""
        keys, sequence = list(self.keys), list(self.sequence_by)
        rows = _prepare(stream, keys, sequence, self.delete_when, self.tie_break)
        places = {f"{PLACE}{i}": _plain(stream, c) for i, c in enumerate(sequence)}
        rest = F.struct(F.lit(True).alias("__is"), *[quoted(c) for c in stream.columns if c not in keys])
        columns = [*[quoted(k) for k in keys], *[c.alias(n) for n, c in places.items()], rest.alias(ROW), LIVE, TIE]
        if self.scd_type == 1:
            rows = rows.select(*columns)
            order = [*places, LIVE, TIE]
            state = StructType([*(rows.schema[c] for c in order), StructField("emitted", LongType())])
            out = StructType([*rows.schema.fields, StructField(EMITTED, LongType())])
            processor = _Latest(order, state)
        else:
            digest = F.lit(0).cast("long") if self.track is None else F.xxhash64(*[comparable(stream, c) for c in self.track])
            rows = rows.select(*columns, digest.alias(DIGEST), _plain(stream, self.valid_from or sequence[-1]).alias(BOUND))
            kinds = {f.name: f.dataType for f in rows.schema.fields}
            added = [StructField(EMITTED, LongType()), StructField(PRESENT, BooleanType()), StructField(UNTIL, kinds[BOUND])]
            out = StructType([StructField(c, kinds[c]) for c in (*keys, *places, ROW)] + added)
            processor = _Versions(keys, list(places), self.track is not None)
        return rows.groupBy(*keys).transformWithState(processor, out, "Append", "None")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Take in all that is available, and stop; a batch that runs again replaces what it wrote."""
        with_rocksdb(
            self.changes(stream), lambda c: c.writeStream.foreachBatch(self._store).option("checkpointLocation", checkpoint).outputMode("append")
        )

    def _store(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.option("basePath", self.path).parquet(self.path).drop(BATCH)
        keys = list(self.keys)
        inner = {f.name: f.dataType for f in stored.schema[ROW].dataType.fields if f.name != "__is"}
        columns = [quoted(c) for c in keys if c not in self.except_cols] + [F.col(ROW)[c].alias(c) for c in inner if c not in self.except_cols]
        if self.scd_type == 1:
            newest = stored.groupBy(*keys).agg(F.max_by(F.struct(ROW, LIVE), EMITTED).alias("__newest"))
            found = newest.where(F.col("__newest")[LIVE]).select(*keys, f"__newest.{ROW}")
        else:
            places = [f"{PLACE}{i}" for i in range(len(self.sequence_by))]
            versions = stored.groupBy(*keys, *places).agg(
                F.max_by(ROW, F.when(F.col(ROW).isNotNull(), F.col(EMITTED))).alias(ROW),
                F.max_by(F.struct(PRESENT, UNTIL), F.when(F.col(PRESENT).isNotNull(), F.col(EMITTED))).alias("__bounds"),
            )
            found = versions.where(F.col("__bounds")[PRESENT])
            start = self.valid_from or self.sequence_by[-1]
            kind = inner[start] if start in inner else stored.schema[start].dataType
            until = F.col("__bounds")[UNTIL]
            until = F.timestamp_micros(until) if isinstance(kind, TimestampType) else until
            columns += validity(F.col(ROW)[start] if start in inner else quoted(start), until, kind.simpleString())
        if self.at is not None:
            columns.append(self.at.alias("processedTime"))
        return found.select(*columns)
