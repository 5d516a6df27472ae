"""Token shards with a minimal perfect hash index (keyed access to raw ids).

Documents are range-partitioned by their key, so shards follow one another in
ascending key order. Each task streams one shard file:

    payload   token ids, unsigned little-endian, 2 bytes where the vocabulary
              has at most 65,536 entries, else 4
    index     numpy arrays: keys, null flags and id offsets in document order;
              the bits of the minimal perfect hash, level by level; for each
              of its values the document's ordinal and a 32-bit fingerprint
    footer    JSON with the arrays' places, its length (8 bytes), a magic word

A key's ids are found in constant time: hash, rank, fingerprint, offset, one
read of the payload. The manifest (a table with one row per shard) names the
files that count; what a failed or repeated task attempt wrote is not in it.

Defined cases: a null text is an empty document (the end id alone); a null key
sorts first and is found by ``None``; rows that share a key are all kept, side
by side, and a lookup returns each of them; an empty table gives an empty
manifest; other columns are ignored whatever their names.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import tokens as T
from . import words as W
from .store import file_system, materialise, prepare, unique_file

MAGIC = b"TOKSHRD1"
SHARD_BYTES = 32 << 20
GAMMA = 2.0
_NULL = np.uint64(0x6E756C6C)
MANIFEST = "shard int, file string, n_docs long, n_ids long, min_key long, max_key long, has_null boolean"


def key_hashes(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """64-bit hashes; different integer keys never share one."""
    return np.where(nulls, W.mix64(np.array([_NULL]))[0] ^ np.uint64(1), W.mix64(keys.astype(np.int64).view(np.uint64)))


class PerfectHash:
    """Minimal perfect hash by cascading bit arrays: a key that is alone at its
    place on a level ends there, the others go to the next level; a key's
    value is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.rank = []
        base = 0
        for bits in levels:
            self.rank.append(np.cumsum(bits, dtype=np.int64) - bits + base)
            base += int(bits.sum())

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (W.mix64(h + np.uint64(level + 1) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> "PerfectHash":
        levels, left = [], hashes
        while len(left):
            size = max(8, int(GAMMA * len(left)))
            place = cls._place(left, len(levels), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, np.uint8)
            bits[place[alone]] = 1
            levels.append(bits)
            left = left[~alone]
        return cls(levels)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        """The value of each hash; -1 for some that are not in the set."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level, (bits, rank) in enumerate(zip(self.levels, self.rank)):
            place = self._place(hashes[left], level, len(bits))
            hit = bits[place] == 1
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (W.mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def _write_shard(stream, ids_of: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], dtype: np.dtype):
    """Stream (keys, nulls, ids, bounds) batches into one shard file."""
    keys, nulls, lengths, at = [], [], [], 0
    for k, null, ids, bounds in ids_of:
        stream.write(ids.astype(dtype, copy=False).tobytes())
        keys.append(k)
        nulls.append(null)
        lengths.append(np.diff(bounds))
        at += len(ids)
    key, null = np.concatenate(keys), np.concatenate(nulls)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<i8")
    h = key_hashes(key, null)
    distinct, first = np.unique(h, return_index=True)
    mph = PerfectHash.build(distinct)
    slot = mph.values(distinct)
    ordinal, finger = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    ordinal[slot], finger[slot] = first, _fingerprint(distinct)
    arrays = {"keys": key.astype("<i8"), "nulls": null.astype("u1"), "offsets": offsets, "ordinals": ordinal,
              "fingerprints": finger, "bits": np.packbits(np.concatenate(mph.levels))}
    place, where = at * dtype.itemsize, {}
    for name, a in arrays.items():
        where[name] = [place, a.dtype.str, len(a)]
        stream.write(a.tobytes())
        place += a.nbytes
    foot = json.dumps({"dtype": dtype.str, "arrays": where, "levels": [len(b) for b in mph.levels]}).encode()
    stream.write(foot + len(foot).to_bytes(8, "little") + MAGIC)
    return len(key), at, key, null


class Shard:
    """One shard file, opened for keyed access."""

    def __init__(self, file: str):
        fs, path = file_system(file)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        tail = self.f.read_at(16, size - 16)
        if bytes(tail[8:]) != MAGIC:
            raise ValueError(f"not a token shard: {file}")
        n = int.from_bytes(tail[:8], "little")
        foot = json.loads(self.f.read_at(n, size - 16 - n))
        self.dtype = np.dtype(foot["dtype"])
        a = {k: np.frombuffer(self.f.read_at(m * np.dtype(t).itemsize, p), t) for k, (p, t, m) in foot["arrays"].items()}
        self.keys, self.nulls, self.offsets = a["keys"], a["nulls"].astype(bool), a["offsets"]
        self.ordinals, self.fingerprints = a["ordinals"], a["fingerprints"]
        new = np.ones(len(self.keys), bool)
        new[1:] = (self.keys[1:] != self.keys[:-1]) | (self.nulls[1:] != self.nulls[:-1])
        self.firsts = np.flatnonzero(new)  # where another key begins
        bits = np.unpackbits(a["bits"])
        cuts = np.cumsum([0, *foot["levels"]])
        self.mph = PerfectHash([bits[i:j] for i, j in zip(cuts[:-1], cuts[1:])])

    def find(self, keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
        """The first ordinal of each key in this shard, -1 where it is not."""
        h = key_hashes(keys, nulls)
        slot = self.mph.values(h)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == _fingerprint(h[known])
        out = np.full(len(h), -1, np.int64)
        out[known] = self.ordinals[slot[known]]
        hit = out >= 0  # a fingerprint may also fit a key that is not there
        out[hit] = np.where((self.nulls[out[hit]] == nulls[hit]) & (nulls[hit] | (self.keys[out[hit]] == keys[hit])), out[hit], -1)
        return out

    def copies(self, ordinal: int) -> range:
        """The ordinals of all documents with the same key."""
        to = ordinal + 1
        while to < len(self.keys) and self.keys[to] == self.keys[ordinal] and self.nulls[to] == self.nulls[ordinal]:
            to += 1
        return range(ordinal, to)

    def documents(self, keys: np.ndarray, nulls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For keys that are stored, in their order: the ordinals that the
        index gives, copies included, and which of the keys each answers."""
        first = self.find(keys, nulls)
        if (first < 0).any():
            raise KeyError(f"the index misses {int((first < 0).sum())} keys")
        ends = np.append(self.firsts, len(self.keys))
        n = ends[np.searchsorted(ends, first, side="right")] - first
        which = np.repeat(np.arange(len(keys)), n)
        return first[which] + np.arange(len(which)) - (np.cumsum(n) - n)[which], which

    def ids(self, ordinal: int, to: int | None = None) -> np.ndarray:
        """The ids of a document, or of those from ``ordinal`` to before ``to``."""
        a, b = self.offsets[ordinal], self.offsets[ordinal + 1 if to is None else to]
        w = self.dtype.itemsize
        return np.frombuffer(self.f.read_at(int(b - a) * w, int(a) * w), self.dtype)

    def close(self) -> None:
        self.f.close()


def _key_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), nulls


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, key: str = "doc_id",
                 text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode all documents and write shards in ascending key order; returns
    the manifest. Rows with one key and different texts may be parted."""
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "token-shards")
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(tokenizer)

        def encoded():
            for batch in batches:
                for part in W.slices(batch):
                    ids, bounds = enc.encode(W.texts_of(part.column("text")), end_id)
                    yield *_key_arrays(part.column("key")), ids, bounds

        stream = encoded()
        first = next(stream, None)
        if first is None:
            return
        file = unique_file(folder, ".shard")
        fs, path = file_system(file)
        with fs.open_output_stream(path) as out:
            docs_n, ids_n, keys, nulls = _write_shard(out, (x for part in ([first], stream) for x in part), enc.dtype)
        real = keys[~nulls]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [file], "n_docs": [docs_n], "n_ids": [ids_n],
            "min_key": pa.array([int(real.min()) if len(real) else None], pa.int64()),
            "max_key": pa.array([int(real.max()) if len(real) else None], pa.int64()), "has_null": [bool(nulls.any())]})

    # a second sort key parts a key with many different texts
    parts = docs.withColumn("tie", F.crc32("text")).repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie")
    return materialise(parts.select("key", "text").mapInArrow(write, MANIFEST), "token-manifest")


def _read_back(shard: Shard, batch_ids: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """Batches of (keys, nulls, starts, lengths, checksums): each key of the
    shard is asked for by the index, in key order, so that reads of the payload
    are sequential. That the answers are all documents, once and in file order,
    is checked by their offsets."""
    keys, nulls = shard.keys[shard.firsts], shard.nulls[shard.firsts]
    ordinals, which = shard.documents(keys, nulls)
    starts, ends = shard.offsets[ordinals], shard.offsets[ordinals + 1]
    if not (np.array_equal(starts, shard.offsets[:-1]) and np.array_equal(ends, shard.offsets[1:])):
        raise ValueError("the index does not give each document once")
    at = 0
    while at < len(ordinals):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + batch_ids, side="right")))
        view = memoryview(shard.ids(int(ordinals[at]), int(ordinals[to - 1]) + 1).astype("<u4").tobytes())
        a, b = starts[at:to], ends[at:to]
        yield (keys[which[at:to]], nulls[which[at:to]], a, b - a,
               [zlib.crc32(view[4 * i:4 * j]) for i, j in zip(a - a[0], b - a[0])])
        at = to


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document as the files have it, through the index: key, start (ids
    of all documents before it), n_tokens and ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers)."""
    spark = manifest.sparkSession
    prepare(spark)
    # one row per shard: a running sum over file sizes, not over documents
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    tasks = max(1, placed.count())

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, base in zip(frame["file"], frame["base"]):
                shard = Shard(file)
                for keys, nulls, starts, lengths, checksums in _read_back(shard):
                    yield pd.DataFrame({"key": pd.Series(keys).astype("Int64").mask(nulls), "start": int(base) + starts,
                                        "n_tokens": lengths, "ids_crc32": checksums})
                shard.close()

    return placed.select("file", "base").repartition(tasks, "file").mapInPandas(read, "key long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Ids of the documents with the given keys (``key``, ``ids``): one row per
    stored document, none for a key that is not stored."""
    spark: SparkSession = manifest.sparkSession
    prepare(spark)
    shards = manifest.orderBy("shard").collect()  # one row per file

    def fetch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[str, Shard] = {}
        for frame in frames:
            nulls = frame[key].isna().to_numpy()
            wanted = frame[key].fillna(0).astype("int64").to_numpy()
            for s in shards:
                mine = (nulls & bool(s.has_null)) if s.min_key is None else \
                    np.where(nulls, bool(s.has_null), (wanted >= s.min_key) & (wanted <= s.max_key))
                if mine.any():
                    if s.file not in open_:
                        open_[s.file] = Shard(s.file)
                    shard = open_[s.file]
                    at = np.flatnonzero(mine)
                    found = shard.find(wanted[at], nulls[at])
                    rows = [(None if nulls[i] else int(wanted[i]), shard.ids(o).astype(np.int64).tolist())
                            for i, f in zip(at, found) if f >= 0 for o in shard.copies(int(f))]
                    if rows:
                        yield pd.DataFrame({"key": pd.array([r[0] for r in rows], "Int64"), "ids": [r[1] for r in rows]})

    return keys.select(F.col(key).cast("long").alias(key)).mapInPandas(fetch, "key long, ids array<long>")
