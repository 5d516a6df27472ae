"""Exact Jaccard join of word n-gram sets with prefix trees.

A text's set holds the hashes of its distinct shingles. Sets are ordered by
one global order, rare shingles first: frequent shingles (counted over all
texts) sort behind, by their count, and ties by hash. Two sets of n and m
shingles that link share at least need(n, m) of them, hence the first k of
their common shingles lie within prefixes of n - least(n) + k. So

1. equal sets are collapsed into classes;
2. a class with fewer than k prefix shingles known to other classes links
   with nothing and is done (k is a small share of n);
3. the others are brought together: the shingles of a set fall into buckets
   by hash, more buckets than a pair may have shingles that differ, so linked
   sets have a bucket in common; components of these (star edges from the
   smallest set of each bucket) are what no linked pair leaves;
4. within a component, sets are stored in a prefix tree with edges of
   ``EDGE`` shingles; a set walks the tree level by level, all nodes of a
   level at once, nodes share the overlap of their path, and a subtree is left
   when its overlap and what remains on either side cannot reach the need;
5. links are joined up to components; pairs are never emitted: a task returns
   a root and a number of links for each of its sets.

A component with many shingles is cut into size classes and hashed blocks,
which are walked pair by pair where their sizes can link, so no task holds a
whole one; small ones share a tree.

Shingles are told apart by 56-bit hashes within a pair of texts.

Defined cases: a null or empty text has no shingles and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as
one; null ids are rows like others (a component's id is its smallest known
one); rows that repeat are all returned; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .components import connected
from .store import materialise, prepare

WIDTH = 5
PERCENT = 80
PREFIX_SHARE = 0.05
#: A shingle is frequent if a single task meets it so often.
FREQUENT = 6
#: The table of frequent shingles sent to all tasks is cut at this length,
#: most frequent first; the rest are ordered like rare ones, which costs
#: time and changes no result.
FREQUENT_ROWS = 200_000
FILTER_BITS = 1 << 27
SLICE_BYTES = 2 << 20
EDGE = 16
BLOCK_SHINGLES = 1 << 19

_HASH = np.uint64((1 << 56) - 1)


def least(n, percent: int):
    """Shingles that a set of n must share with any partner."""
    return -(-n * percent // 100)


def need(n, m, percent: int):
    """Shingles that sets of n and m share at least if 100 * shared >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def _by_text(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The order by (doc, value)."""
    order = np.argsort(values, kind="stable")
    small = np.uint16 if not len(doc) or doc[-1] < 1 << 16 else np.uint32  # numpy has a radix sort for short integers
    return order[np.argsort(doc[order].astype(small), kind="stable")]


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (56 bits) of each text, ascending, and bounds."""
    h, bounds = W.shingles(W.split(texts, lower=True), width)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    h = h & _HASH
    order = _by_text(h, doc)
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[first], doc[first]
    return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


def frequent_shingles(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """(shingle, n): shingles that some task met FREQUENT times or more, with
    the sum of these counts. A task counts what it has met twice in one slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                h, _ = _sets(W.texts_of(part.column("text")), width)
                h, n = np.unique(h, return_counts=True)
                at = np.searchsorted(seen, h)
                known = (at < len(seen)) & (seen[np.minimum(at, max(len(seen) - 1, 0))] == h) if len(seen) else np.zeros(len(h), bool)
                counts[at[known]] += n[known]
                new = ~known & (n > 1)
                seen, counts = np.concatenate([seen, h[new]]), np.concatenate([counts, n[new]])
                order = np.argsort(seen, kind="stable")
                seen, counts = seen[order], counts[order]
        hot = counts >= FREQUENT
        yield pa.RecordBatch.from_arrays([pa.array(seen[hot].astype(np.int64)), pa.array(counts[hot])], names=["shingle", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle long, n long")
    return found.groupBy("shingle").agg(F.sum("n").alias("n"))


class Order:
    """The global order as a number: 7 bits for the frequency, 56 for the hash."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        at = np.argsort(shingles)
        self.shingles = shingles[at].astype(np.uint64)
        self.rank = np.clip(4 * np.log2(counts[at].astype(float)), 1, 127).astype(np.uint64) if len(at) else np.zeros(0, np.uint64)

    def keys(self, h: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return h.astype(np.int64)
        at = np.minimum(np.searchsorted(self.shingles, h), len(self.shingles) - 1)
        rank = np.where(self.shingles[at] == h, self.rank[at], np.uint64(0))
        return ((rank << np.uint64(56)) | h).astype(np.int64)


def _ordered(texts: pa.Array, width: int, order: Order) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sets in the global order, their bounds, and a 128-bit name of each set."""
    h, bounds = _sets(texts, width)
    names = [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
    keys = order.keys(h)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return keys[_by_text(keys, doc)], bounds, names


def size_classes(largest: int, percent: int) -> np.ndarray:
    """Upper bounds of size classes; partners are in the same or in
    neighbouring ones."""
    upper = [1]
    while upper[-1] < largest:
        upper.append(max(upper[-1] + 1, upper[-1] * 100 // percent))
    return np.array(upper, np.int64)


def differing(upper, percent: int):
    """Shingles that are in one only of two linked sets, at most, if both have
    at most ``upper``."""
    return 2 * upper * (100 - percent) // (100 + percent)


def signatures(keys: np.ndarray, bounds: np.ndarray, percent: int) -> list[np.ndarray]:
    """Hashes of each set's buckets, for its size class and the next one.

    With D shingles that may differ there are D + D // 8 + 2 buckets, so two
    linked sets agree in more than D // 8 + 1 of them. A set with so many
    empty buckets that all of these may be empty also gives its prefix shingles:
    of a pair, either one has a full bucket in common or both do so."""
    n = np.diff(bounds)
    upper = size_classes(int(n.max()) if len(n) else 1, percent)
    upper = np.append(upper, max(upper[-1] + 1, upper[-1] * 100 // percent))
    own = np.searchsorted(upper, n)
    parts: list[list[np.ndarray]] = [[] for _ in n]
    doc = np.repeat(np.arange(len(n)), n)
    value = keys.astype(np.uint64)
    for step in (0, 1):
        c = np.minimum(own + step, len(upper) - 1)
        d = differing(upper[c], percent)
        count = d + d // 8 + 2
        first = np.cumsum(count) - count
        with np.errstate(over="ignore"):
            salt = W.mix64(c.astype(np.uint64) + np.uint64(1))[doc]
            bucket = (W.mix64(value ^ salt) % count.astype(np.uint64)[doc]).astype(np.int64)
            order = np.argsort(first[doc] + bucket, kind="stable")
            at = (first[doc] + bucket)[order]
            start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
            total = np.add.reduceat(W.mix64(value + salt)[order], start) if len(start) else np.zeros(0, np.uint64)
            of = doc[order][start]
            name = W.mix64(total ^ W.mix64(bucket[order][start].astype(np.uint64) ^ salt[order][start])).view(np.int64)
        cut = np.searchsorted(of, np.arange(len(n) + 1))
        for i in range(len(n)):
            parts[i].append(name[cut[i]:cut[i + 1]])
            if count[i] - (cut[i + 1] - cut[i]) >= d[i] // 8 + 2 and n[i]:
                parts[i].append(keys[bounds[i]:bounds[i] + n[i] - least(n[i], percent) + 1])
    return [np.unique(np.concatenate(p)) for p in parts]


class PrefixTree:
    """Sets (ascending arrays of small numbers) by levels of EDGE elements. A
    level has a row per node: its elements, where its parent is, the range
    of its children, the set that ends in it, and for the subtree the least and
    greatest size of a set and the most elements still to come."""

    def __init__(self, sets: list[np.ndarray], vocabulary: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.pad = vocabulary
        self.levels: list[dict[str, np.ndarray]] = []
        rows = np.arange(len(sets))
        parent = np.zeros(len(sets), np.int64)
        depth = 0
        while len(rows):
            edge = np.full((len(rows), EDGE), vocabulary, np.int64)
            for i, r in enumerate(rows):
                part = sets[r][depth * EDGE:(depth + 1) * EDGE]
                edge[i, :len(part)] = part
            node_of = np.concatenate([parent[:, None], edge], axis=1)
            nodes, node = np.unique(node_of, axis=0, return_inverse=True)
            node = node.ravel()
            size = self.sizes[rows]
            k = len(nodes)
            low, high = np.full(k, np.iinfo(np.int64).max), np.zeros(k, np.int64)
            np.minimum.at(low, node, size)
            np.maximum.at(high, node, size)
            ends = size <= (depth + 1) * EDGE
            last = np.full(k, -1)
            last[node[ends]] = rows[ends]  # sets differ, so one ends in a node at most
            self.levels.append({"edge": nodes[:, 1:], "parent": nodes[:, 0], "low": low, "high": high, "set": last,
                                "last": np.where(nodes[:, 1:] < vocabulary, nodes[:, 1:], -1).max(1)})
            rows, parent, depth = rows[~ends], node[~ends], depth + 1
        for above, below in zip(self.levels, self.levels[1:]):
            edge_to = np.arange(len(above["low"]) + 1)
            above["children"] = np.searchsorted(below["parent"], edge_to)  # nodes are sorted by parent
        if self.levels:
            self.levels[-1]["children"] = np.zeros(len(self.levels[-1]["low"]) + 1, np.int64)

    def partners(self, x: np.ndarray, percent: int, hit: np.ndarray) -> np.ndarray:
        """Sets that link with ``x``. ``hit`` is all false, one longer than the vocabulary."""
        n = len(x)
        hit[x] = True
        found = []
        at = np.arange(len(self.levels[0]["low"]))
        overlap = np.zeros(len(at), np.int64)
        for depth, level in enumerate(self.levels):
            near = (level["high"][at] * 100 >= percent * n) & (level["low"][at] * percent <= 100 * n)
            at, overlap = at[near], overlap[near]
            if not len(at):
                break
            overlap = overlap + hit[level["edge"][at]].sum(1)
            done = level["set"][at]
            ends = done >= 0
            if ends.any():
                m = self.sizes[done[ends]]
                found.append(done[ends][overlap[ends] >= need(n, m, percent)])
            # what is left of x behind this node, and of the longest set below it
            below = level["high"][at] - (depth + 1) * EDGE
            rest = np.minimum(n - np.searchsorted(x, level["last"][at], side="right"), below)
            # the least that any set below could need
            wanted = need(n, np.maximum(level["low"][at], least(n, percent)), percent)
            go = (below > 0) & (overlap + rest >= wanted)
            at, overlap = at[go], overlap[go]
            a, b = level["children"][at], level["children"][at + 1]
            count = b - a
            overlap = np.repeat(overlap, count)
            at = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())
        hit[x] = False
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def join_sets(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Links among distinct ordered sets: per set the smallest set that it is
    connected with, and (set, partners) of those that have partners. With
    ``sides`` (0 or 1) only links between the sides count."""
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([0, *map(len, sets)])
    small = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    stored = np.arange(len(sets)) if sides is None else np.flatnonzero(sides == 0)
    asking = np.arange(len(sets)) if sides is None else np.flatnonzero(sides == 1)
    root, out = np.arange(len(sets)), []
    if not len(stored) or not len(asking):
        return root, out
    tree = PrefixTree([small[i] for i in stored], len(values))
    hit = np.zeros(len(values) + 1, bool)
    for i in asking:
        with_ = stored[tree.partners(small[i], percent, hit)]
        with_ = with_[with_ != i]
        if len(with_):
            out.append((int(i), with_))
            same = np.unique(np.concatenate([root[[i]], root[with_]]))
            if len(same) > 1:
                root[np.isin(root, same[1:])] = same[0]
    return root, out


def _bits(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap of hashes modulo its size, which grows with their number up to
    FILTER_BITS: what is not in it need not be looked at; beyond the bound it
    lets more rows pass, which an exact join sorts out."""
    n = hashes.count()
    size = 1 << int(np.clip(int(max(n, 1) * 16).bit_length(), 15, FILTER_BITS.bit_length() - 1))
    at = hashes.select(F.pmod(F.col(column), F.lit(size)).alias("at"))
    parts = at.groupBy(F.floor(F.col("at") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(32768))).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for row in parts.toLocalIterator():  # 4 KB each
        out[row["part"] * 4096:row["part"] * 4096 + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def _passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = np.mod(hashes, len(bits) * 8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _joined(docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """Per row: id, hash (of id and text), n, class_id, component (the node
    that names it; null without words), component_id, n_links."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    prefix_share = PREFIX_SHARE
    hot = frequent_shingles(docs, width, text).orderBy(F.desc("n"), "shingle").limit(FREQUENT_ROWS).toPandas()
    order = spark.sparkContext.broadcast(Order(hot["shingle"].to_numpy(np.int64), hot["n"].to_numpy(np.int64)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                keys, bounds, names = _ordered(W.texts_of(part.column("text")), width, order.value)
                n = np.diff(bounds)
                k = np.maximum(1, np.ceil(prefix_share * n).astype(np.int64))
                p = np.where(n > 0, np.minimum(n, n - least(n, percent) + k), 0)
                cut = np.concatenate([[0], np.cumsum(p)])
                prefix = keys[np.repeat(bounds[:-1] - cut[:-1], p) + np.arange(cut[-1])]
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(prefix))
                short = np.frombuffer(b"".join(x[:8] for x in names), np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("hash"), pa.array(names, pa.binary()), pa.array(short), pa.array(n), pa.array(k), lists],
                                                 names=["id", "hash", "name", "short", "n", "k", "prefix"])

    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(key, text).alias("hash"))
    signed = materialise(rows.mapInArrow(sign, f"id {id_type}, hash long, name binary, short long, n long, k long, prefix array<long>"), "ngram-sets")

    # 1. classes of equal sets; one row stands for each
    classes = signed.where("n > 0").groupBy("name").agg(F.min(F.struct("id", "hash")).alias("first"), F.min("id").alias("class_id"), F.min("short").alias("short"),
                                                        F.min("n").alias("n"), F.min("k").alias("k"), F.count("*").alias("copies"))
    classes = classes.select("name", "short", "class_id", F.col("first.hash").alias("hash"), "n", "k", "copies")
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "ngram-classes")

    # 2. sets with enough prefix shingles that other sets share (here sets go
    # by 64 bits of their name: two that met by chance would be looked at)
    posted = signed.select("short", F.explode("prefix").alias("shingle"))
    shared = posted.groupBy("shingle").agg(F.min("short").alias("a"), F.max("short").alias("b")).where("a < b").select(F.col("shingle").alias("shared"))
    known = posted.join(shared, F.col("shingle") == F.col("shared")).groupBy("short").agg(F.count("*").alias("known")).withColumnRenamed("short", "of")
    open_ = classes.join(known, F.col("short") == F.col("of")).where("known >= k * copies").select("name", "hash", "node")
    open_ = materialise(open_, "ngram-open")

    # 3. whole sets of these, and components of those that meet in a bucket
    bits = spark.sparkContext.broadcast(_bits(open_, "hash"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.flatnonzero(_passing(hashes, bits.value))))
            for part in W.slices(batch, "text", SLICE_BYTES):
                keys, bounds, names = _ordered(W.texts_of(part.column("text")), width, order.value)
                yield pa.RecordBatch.from_arrays([
                    part.column("hash"), pa.array(names, pa.binary()), pa.array([keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    pa.array(signatures(keys, bounds, percent), pa.list_(pa.int64()))], names=["hash_", "name_", "keys", "buckets"])

    full = rows.select("hash", "text").mapInArrow(whole, "hash_ long, name_ binary, keys binary, buckets array<long>")
    full = full.join(open_, (F.col("name_") == F.col("name")) & (F.col("hash_") == F.col("hash"))).dropDuplicates(["name_", "hash_"])
    full = materialise(full.select("node", "keys", "buckets", F.expr("octet_length(keys) div 8").alias("n")), "ngram-whole")
    meeting = full.select("node", F.explode("buckets").alias("bucket"))
    stars = meeting.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("met")).where("met > 1").withColumnRenamed("bucket", "by")
    edges = meeting.join(stars, F.col("bucket") == F.col("by")).where("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    groups = materialise(connected(edges).select("node_", F.col("component").alias("grp")), "ngram-groups")

    # 4. links within each component, by prefix trees: a small component is in
    # one task with others; a large one is cut by size (partners are in the same
    # or the next class) and then by hash, and the parts meet two by two
    ratio = math.log(100.1 / percent) if percent < 100 else 1.0  # a little more than partners may differ by
    members = full.select("node", "n").join(groups, F.col("node") == F.col("node_")).select(
        "node_", "n", "grp", F.floor(F.log(F.col("n")) / ratio).cast("int").alias("class"))
    members = materialise(members, "ngram-members")
    weight = members.groupBy("grp", "class").agg(F.sum("n").alias("w"))
    weight = weight.withColumn("blocks", F.expr(f"cast((w + {BLOCK_SHINGLES - 1}) div {BLOCK_SHINGLES} as int)"))
    cells = F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("cells")  # a class for each factor of size: a few dozen
    sizes = materialise(weight.groupBy(F.col("grp").alias("of")).agg(F.sum("w").alias("weight"), cells), "ngram-sizes")
    shares = max(1, -(-(sizes.agg(F.sum("weight")).first()[0] or 0) // BLOCK_SHINGLES))
    dealt = members.join(sizes, F.col("grp") == F.col("of")).withColumn("large", F.col("weight") > BLOCK_SHINGLES)
    blocks = lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(0))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node_"), blocks(F.col("class"))).cast("int"))

    def meets(kind: str, count: Column, i, j, class_: Column) -> Column:
        others = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(others, lambda o: F.struct(F.lit(kind).alias("kind"), class_.alias("class"), i(o).alias("i"), j(o).alias("j")))

    own = F.col("block")
    pairs = F.concat(meets("same", blocks(F.col("class")), lambda o: F.least(own, o), lambda o: F.greatest(own, o), F.col("class")),
                     meets("next", blocks(F.col("class") + 1), lambda o: own, lambda o: o, F.col("class")),
                     meets("next", blocks(F.col("class") - 1), lambda o: o, lambda o: own, F.col("class") - 1))
    together = F.array(F.struct(F.lit("all").alias("kind"), F.lit(0).alias("class"), F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = dealt.select("node_", F.col("class").alias("own_class"), "block", F.when(F.col("large"), F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(shares))).alias("task"),
                         F.explode(F.when(F.col("large"), pairs).otherwise(together)).alias("meet"))
    # 1 for the second of two parts
    second = F.when(F.col("meet.kind") == "next", F.col("own_class") != F.col("meet.class")).otherwise(F.col("block") != F.col("meet.i"))
    dealt = dealt.select("node_", "task", "meet.*", second.cast("int").alias("side"))
    full = full.select("node", "keys").join(dealt, F.col("node") == F.col("node_")).drop("node_")

    def link(key, frame: pd.DataFrame) -> pd.DataFrame:
        kind, i, j = key[1], int(key[3]), int(key[4])
        apart = kind == "next" or kind == "same" and i != j
        frame = frame.sort_values("node", kind="stable")
        sets = [np.frombuffer(x, np.int64) for x in frame["keys"]]
        node = frame["node"].to_numpy(np.int64)
        root, pairs = join_sets(sets, percent, frame["side"].to_numpy() if apart else None)
        links = np.zeros(len(node), np.int64)
        for a, with_ in pairs:
            links[a] += len(with_)
            if apart:
                links[with_] += 1
        hit = links > 0
        return pd.DataFrame({"node": node[hit], "root": node[root[hit]], "links": links[hit]})

    found = materialise(full.groupBy("task", "kind", "class", "i", "j").applyInPandas(link, "node long, root long, links long"), "ngram-links")

    # 5. components of links, back to all rows
    joined = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("node").alias("_of")).agg(F.sum("links").alias("links"))
    ends = classes.join(joined, F.col("node") == F.col("node_"), "left").join(links, F.col("node") == F.col("_of"), "left")
    ends = ends.select("name", "class_id", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"))
    least_ = ends.groupBy("component").agg(F.min("class_id").alias("component_id")).withColumnRenamed("component", "_component")
    ends = ends.join(least_, F.col("component") == F.col("_component")).select(F.col("name").alias("_name"), "class_id", "component", "component_id", "n_links")
    out = signed.select("id", "hash", "name", "n").join(ends, (F.col("name") == F.col("_name")) & (F.col("n") > 0), "left")
    own = lambda c: F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("id")).alias(c)
    return out.select("id", "hash", "n", own("class_id"), "component", own("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def similar(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, class_id (the smallest id with
    the same set), component_id (the smallest id reachable by links) and
    n_links (other classes that its class links with)."""
    rows = _joined(docs, width, percent, key, text)
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "class_id", "component_id", "n_links")


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id (null
    first); rows without a word are all kept."""
    rows = _joined(docs, width, percent, key, text).where(F.col("component").isNotNull())
    first = rows.groupBy("component").agg(F.min(F.struct("id", "hash")).alias("first"))
    first = first.select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash"))
    wordless = F.coalesce(F.col(text), F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")
    hashed = docs.where(~wordless).withColumn("_row_hash", F.xxhash64(key, text))
    kept = hashed.join(first, (F.col("_row_hash") == F.col("_hash")) & F.col(key).eqNullSafe(F.col("_id")), "left_semi")
    # the same id and text may stand in several rows
    kept = kept.dropDuplicates([key, "_row_hash"])
    return kept.select(*docs.columns).unionAll(docs.where(wordless))
