"""One segmented scan for lags, fills and effective status.

The table is range-partitioned by (entity, order) with Spark's sampled range
partitioner, sorted within its partitions and checkpointed, so an entity of any
size is spread over as many ranges as its rows need and all tasks get about
equal parts. A row is then a place in one long sequence, an entity a segment
of it.

What a range passes on is a small state: the entity that it ends with, that
entity's last values, its last value that is not missing, and whether the
entity began before the range. Two states merge into one (``State.merge``), so
one pass reduces each range to one state, the driver merges them in order (one
row per range) and a second pass gives every range the state of all rows
before it. All lags, fills and status columns of an operator come from that
one scan. Values are moved by position in Arrow arrays and keep their types.

NULL entities are an entity like others, and order values sort as Spark sorts
them (NULL first). Rows that tie in the whole order come in the order of a
hash of their values, so results don't depend on the partitioning.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Lag:
    """The value of ``column`` ``n`` rows back within the entity (``reset``),
    or in the whole sequence."""

    column: str
    n: int
    out: str
    reset: bool = True


@dataclass(frozen=True)
class Fill:
    """Forward fill of ``column``: the last value that is not missing, the
    entity's first row being forced to ``first`` if given. ``before``: a column
    for the filled value of the previous row of the entity."""

    column: str
    out: str
    first: object = None
    before: str | None = None


def _same(a: list, b: list) -> bool:
    return all(x == y or (x is None and y is None) or (x != x and y != y) for x, y in zip(a, b))


def _starts(columns: list[pa.Array], n: int) -> np.ndarray:
    """True where a row has another entity than the row before it."""
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _copied(values: pa.Array, a: int, b: int) -> pa.Array:
    """Some values on their own, without the batch that they come from."""
    return values.take(pa.array(np.arange(a, b)))


@dataclass
class State:
    """What a run of rows passes on. ``tails`` are the last values of its last
    entity, ``ends`` those of the run, per lagged column; ``head`` and ``rest``
    are, per filled column, that entity's value in its first row of the run and
    its last one after it that is not missing (one-value arrays)."""

    entity: list
    open: bool
    n: int                      # rows of the last entity
    tails: dict[str, pa.Array] = field(default_factory=dict)
    ends: dict[str, pa.Array] = field(default_factory=dict)
    head: dict[str, pa.Array] = field(default_factory=dict)
    rest: dict[str, pa.Array] = field(default_factory=dict)

    def merge(self, later: "State", rows: int) -> "State":
        """The state of this run and the one after it."""
        join = lambda a, b: {c: pa.concat_arrays([a[c], b[c]])[-rows:] for c in b} if rows else {c: b[c][:0] for c in b}
        ends = join(self.ends, later.ends)
        if not (later.open and _same(self.entity, later.entity)):
            return State(later.entity, False, later.n, later.tails, ends, later.head, later.rest)
        rest = {c: next((v for v in (later.rest[c], later.head[c]) if v.null_count == 0), self.rest[c]) for c in later.rest}
        return State(self.entity, self.open, self.n + later.n, join(self.tails, later.tails), ends, self.head, rest)


class Scan:
    """The work of one operator on the rows of a range; picklable."""

    def __init__(self, entity: Sequence[str], lags: Sequence[Lag], fills: Sequence[Fill], number: str | None = None):
        self.entity, self.lags, self.fills, self.number = list(entity), list(lags), list(fills), number
        self.rows = max((lag.n for lag in lags), default=0)
        self.lagged = list(dict.fromkeys(lag.column for lag in lags))
        self.filled = list(dict.fromkeys(f.column for f in fills))

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.entity, *self.lagged, *self.filled]))

    def _last(self, values: pa.Array, at: int) -> pa.Array:
        return values.take(pa.array([at if at >= 0 else None], pa.int64()))

    def state(self, b: pa.RecordBatch) -> State:
        """The state of a batch of rows (one at least)."""
        n = b.num_rows
        new = _starts([b.column(c) for c in self.entity], n)
        start = int(np.flatnonzero(new)[-1])
        out = State([b.column(c)[n - 1].as_py() for c in self.entity], start == 0, n - start)
        for c in self.lagged:
            out.ends[c] = _copied(b.column(c), max(0, n - self.rows), n)
            out.tails[c] = _copied(b.column(c), max(start, n - self.rows), n)
        for c in self.filled:
            valid = np.flatnonzero(b.column(c).is_valid().to_numpy(zero_copy_only=False)[start + 1:])
            out.head[c] = _copied(b.column(c), start, start + 1)
            out.rest[c] = self._last(b.column(c), start + 1 + int(valid[-1]) if len(valid) else -1)
        return out

    def _carried(self, f: Fill, before: State, kind: pa.DataType) -> pa.Array:
        """The filled value of the last row before."""
        if before.rest[f.column].null_count == 0:
            return before.rest[f.column]
        return pa.array([f.first], kind) if f.first is not None else before.head[f.column]

    def outputs(self, b: pa.RecordBatch, before: State | None) -> list[pa.Array]:
        """The new columns of a batch after rows with the state ``before``."""
        n = b.num_rows
        new = _starts([b.column(c) for c in self.entity], n)
        goes_on = before is not None and _same(before.entity, [b.column(c)[0].as_py() for c in self.entity])
        row = np.arange(n)
        start = np.maximum.accumulate(np.where(new, row, 0))
        out = []
        for lag in self.lags:
            values = b.column(lag.column)
            tail = before.ends[lag.column] if before and not lag.reset else before.tails[lag.column] if goes_on else values[:0]
            at = row - lag.n
            floor = np.where(start == 0, -len(tail), start) if lag.reset else -len(tail)
            out.append(pa.concat_arrays([tail, values]).take(pa.array(at + len(tail), mask=at < floor)))
        for f in self.fills:
            values = b.column(f.column)
            first = new.copy()
            first[0] &= not goes_on
            if f.first is not None:
                values = pc.if_else(pa.array(first), pa.scalar(f.first, values.type), values)
            carried = self._carried(f, before, values.type) if goes_on else self._last(values, -1)
            valid = values.is_valid().to_numpy(zero_copy_only=False)
            found = np.maximum.accumulate(np.where(valid, row, -1))
            # place 0 is the carried value, place i + 1 row i
            at = np.where(found >= start, found + 1, np.where(start == 0, 0, -1))
            filled = pa.concat_arrays([carried, values]).take(pa.array(at, mask=at < 0))
            out.append(filled)
            if f.before:
                out.append(pa.concat_arrays([carried, filled]).take(pa.array(row, mask=new & ~((row == 0) & goes_on))))
        if self.number:
            out.append(pa.array(row - start + np.where(start == 0, before.n if goes_on else 0, 0), pa.int64()))
        return out

    def names(self) -> list[tuple[str, str | None]]:
        """(new column, column whose type it has; none: a long)."""
        out = [(lag.out, lag.column) for lag in self.lags]
        for f in self.fills:
            out += [(f.out, f.column)] + ([(f.before, f.column)] if f.before else [])
        return out + ([(self.number, None)] if self.number else [])


def segmented(df: DataFrame, entity: Sequence[str], order: Sequence, lags: Sequence[Lag] = (), fills: Sequence[Fill] = (),
              ranges: int | None = None, number: str | None = None) -> DataFrame:
    """``df`` with the columns of all ``lags`` and ``fills``, and as ``number``
    the 0-based place of a row in its entity (all rows are one without ``entity``). ``ranges``: how
    many parts the table is cut into (else ``spark.sql.shuffle.partitions``,
    merged by AQE where they are small)."""
    from tessera.session import cut_lineage, ship_package

    ship_package(df.sparkSession)
    scan = Scan(entity, lags, fills, number)
    made = scan.names()
    df = df.drop(*[n for n, _ in made])
    ties = F.xxhash64(*[F.col(c) for c, t in df.dtypes if "map<" not in t and t != "variant"])
    keys = [*[F.col(c) for c in entity], *[F.col(c) if isinstance(c, str) else c for c in order], ties]
    spread = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    spread = cut_lineage(spread.sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id()))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, number = None, None
        for b in batches:
            if b.num_rows:
                s = scan.state(b)
                whole, number = s if whole is None else whole.merge(s, scan.rows), b.column("_range")[0].as_py()
        if whole is not None:
            yield pa.RecordBatch.from_pydict({"_range": pa.array([number], pa.int32()), "state": pa.array([pickle.dumps(whole)], pa.binary())})

    states = spread.select("_range", *scan.columns()).mapInArrow(reduce, "_range int, state binary").collect()   # one row per range
    before, so_far = {}, None
    for r in sorted(states, key=lambda r: r["_range"]):
        if so_far is not None:
            before[r["_range"]] = pickle.dumps(so_far)
        own = pickle.loads(r["state"])
        so_far = own if so_far is None else so_far.merge(own, scan.rows)
    shared = df.sparkSession.sparkContext.broadcast(before)   # one small state per range
    types = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema.fields], *[T.StructField(n, types[c] if c else T.LongType()) for n, c in made]])
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, number = None, None
        for b in batches:
            if not b.num_rows:
                continue
            if number is None:
                number = b.column("_range")[0].as_py()
                so_far = pickle.loads(shared.value[number]) if number in shared.value else None
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *scan.outputs(b, so_far)], names=[*kept, *[n for n, _ in made]])
            own = scan.state(b)
            so_far = own if so_far is None else so_far.merge(own, scan.rows)

    return spread.mapInArrow(run, schema)
