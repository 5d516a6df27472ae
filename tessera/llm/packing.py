"""Packing of tokenised documents into sequences by length patterns.

Only the histogram of piece lengths (at most ``capacity`` bins) is needed to
plan. The driver enumerates patterns of a few lengths that fill a sequence,
fits how often to repeat each by non-negative least squares against the
histogram, rounds down to what the histogram holds, and packs the residual
counts by best fit, again as repeated patterns. The plan says, for each
length, which ranks go to which sequences and offsets; pieces are ranked
within their length on the cluster and placed by the plan.

Defined cases: a null text is empty and gives one piece (the end id alone);
only documents longer than ``capacity`` are cut; rows that repeat are packed
as often as they occur; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T
from . import words as W
from .store import materialise, prepare

CAPACITY = 4096
PATTERNS = 40_000
NNLS_STEPS = 400
RANK_ROWS = 1_000


def tokenise_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, key: str = "doc_id",
                    text: str = "text", with_ids: bool = False) -> DataFrame:
    """Ids of every document and the end id, cut every ``capacity`` ids:
    key, piece, start, length, ids_crc32 (and the ids, as raw bytes)."""
    prepare(docs.sparkSession)
    out_schema = f"{key} long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(tokenizer)
        for batch in batches:
            for part in W.slices(batch, text):
                ids, bounds = enc.encode(W.texts_of(part.column(text)), end_id)
                n = np.diff(bounds)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                view = memoryview(ids.astype("<u4").tobytes())
                at = bounds[doc] + start
                cut = [view[4 * a:4 * b] for a, b in zip(at, at + length)]
                cols = [part.column(key).cast(pa.int64()).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array([zlib.crc32(x) for x in cut], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(x) for x in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in out_schema.split(", ")])

    return docs.select(key, text).mapInArrow(run, out_schema)


def _patterns(hist: np.ndarray, capacity: int, limit: int) -> list[tuple[int, ...]]:
    """Combinations of a few present lengths that fill a sequence, most of
    them without a gap."""
    present = np.flatnonzero(hist)
    fits = np.zeros(capacity + 1, np.int64)  # the largest present length up to each number
    fits[present] = present
    fits = np.maximum.accumulate(fits)
    found: set[tuple[int, ...]] = set()
    for a in present:  # pairs, and as many copies as fit with the best rest
        for copies in {1, capacity // a}:
            rest = capacity - int(a) * copies
            made = [int(a)] * copies
            while rest and fits[rest]:
                made.append(int(fits[rest]))
                rest -= made[-1]
            if len(made) <= 12:
                found.add(tuple(sorted(made, reverse=True)))
    rng = np.random.default_rng(7)
    weight = hist[present] / hist.sum()
    for _ in range(limit):  # partners drawn as often as the histogram has them
        if len(found) >= limit:
            break
        rest, made = capacity, []
        for x in rng.choice(present, size=10, p=weight):
            if x <= rest:
                made.append(int(x))
                rest -= int(x)
            if fits[rest] == rest:
                if rest:
                    made.append(rest)
                rest = 0
                break
        while rest and fits[rest] and len(made) < 12:
            made.append(int(fits[rest]))
            rest -= made[-1]
        found.add(tuple(sorted(made, reverse=True)))
    return sorted(found)


def nnls(patterns: list[tuple[int, ...]], hist: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Repeat counts c >= 0 that minimise ||A c - hist||^2, where A[l, j] is how
    often pattern j has length l: accelerated projected gradient with restarts."""
    j = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    ell = np.concatenate([np.array(p) for p in patterns])
    n, m = len(patterns), len(hist)
    # diagonal scaling: frequent lengths meet in many patterns
    d = 1.0 / np.maximum(np.bincount(j, weights=np.bincount(ell, minlength=m)[ell], minlength=n), 1.0)
    c = np.zeros(n)
    y, t, last = c.copy(), 1.0, np.inf
    for _ in range(steps):
        r = np.bincount(ell, weights=y[j], minlength=m) - hist
        loss = float(r @ r)
        if loss > last:  # restart the acceleration
            y, t = c.copy(), 1.0
            r = np.bincount(ell, weights=y[j], minlength=m) - hist
            loss = float(r @ r)
        new = np.maximum(0.0, y - d * np.bincount(j, weights=r[ell], minlength=n))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - c)
        c, t, last = new, t_new, loss
    return c


def plan(hist: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) pairs that use each length exactly as often as
    ``hist`` (index: length) has it."""
    left = np.asarray(hist, np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...], times: int) -> None:
        need = np.bincount(pattern, minlength=len(left))
        at = np.flatnonzero(need)
        times = min(times, int((left[at] // need[at]).min()))
        if times > 0:
            left[at] -= need[at] * times
            out.append((pattern, times))

    if left.sum():
        patterns = _patterns(left, capacity, PATTERNS)
        c = nnls(patterns, left.astype(float))
        full = [sum(p) for p in patterns]
        for i in sorted(range(len(patterns)), key=lambda i: (-full[i], -c[i])):
            if full[i] >= capacity - capacity // 100 and c[i] >= 1:
                use(patterns[i], int(c[i]))
    while left.any():  # best fit of the residual counts: the longest first, then the longest that fits
        rest, made = capacity, []
        free = left.copy()
        present = np.flatnonzero(free)
        at = len(present)
        while rest > 0 and at:
            at = int(np.searchsorted(present, rest, side="right"))
            while at and not free[present[at - 1]]:
                at -= 1
            if not at:
                break
            x = int(present[at - 1])
            made.append(x)
            free[x] -= 1
            rest -= x
        use(tuple(made), 1 << 62)
    return out


def _entries(packed: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length: rank ranges, their first sequence and the offset."""
    rows, sequence = [], 0
    for pattern, times in packed:
        offset = 0
        for x in pattern:
            rows.append((x, times, sequence, offset))
            offset += x
        sequence += times
    a = np.array(rows, np.int64).reshape(-1, 4)
    a = a[np.argsort(a[:, 0], kind="stable")]
    first = np.zeros(len(a), np.int64)
    total = np.cumsum(a[:, 1]) - a[:, 1]
    starts = np.flatnonzero(np.concatenate([[True], a[1:, 0] != a[:-1, 0]])) if len(a) else np.zeros(0, int)
    sizes = np.diff(np.concatenate([starts, [len(a)]]))
    first = total - np.repeat(total[starts], sizes) if len(a) else first
    return {"length": a[:, 0], "rank": first, "sequence": a[:, 2], "offset": a[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` (any columns; ``length`` from 1 to ``capacity``) and for each
    row its ``sequence_id`` and ``offset``. The input is read twice: give it
    materialised. A frequent length is ranked in salted buckets of about
    ``RANK_ROWS`` rows."""
    spark = pieces.sparkSession
    prepare(spark)
    out_cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]  # replaced if there
    salt_from = [c for c, t in pieces.dtypes if not t.startswith("map")]
    hist = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy(F.col(length).alias("length")).count().collect():  # at most ``capacity`` rows
        hist[row["length"]] = row["count"]
    entries = _entries(plan(hist, capacity))
    buckets = F.get(F.lit(np.maximum(1, -(-hist // RANK_ROWS))), F.col(length).cast("int"))
    shared = spark.sparkContext.broadcast(entries)  # a few numbers for each pattern of the plan; bounded by capacity and PATTERNS
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), buckets).cast("int"))
    sizes = salted.groupBy(F.col(length).alias("_length"), F.col("_salt").alias("_bucket")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    order = Window.partitionBy(length, "_salt").orderBy(*[F.col(c) for c in salt_from])
    ranked = salted.withColumn("_row", F.row_number().over(order) - 1)
    ranked = ranked.join(sizes, (F.col(length) == F.col("_length")) & (F.col("_salt") == F.col("_bucket")))
    ranked = ranked.select(*out_cols, (F.col("_row") + F.col("_before")).alias("_rank"))
    schema = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = shared.value
        # (length, rank) as one ascending number; ranks stay below 2**48
        keys = (e["length"] << 48) + e["rank"]
        for b in batches:
            ell = b.column(length).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, (ell << 48) + rank, side="right") - 1
            cols = [b.column(c) for c in out_cols]
            cols += [pa.array(e["sequence"][at] + rank - e["rank"][at]), pa.array(e["offset"][at])]
            yield pa.RecordBatch.from_arrays(cols, names=[*out_cols, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: sequence_id and the raw ids of its
    pieces one after the other (a sequence holds ``capacity`` ids at most)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts.ids, cast('' as binary), (a, x) -> a || x)").alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(materialise(tokenise_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
