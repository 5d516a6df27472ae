"""Near-duplicate vectors by product quantisation.

Equal vectors are collapsed into classes first. Coarse centroids and the
codebooks of residual subspaces are fitted on a bounded sample; every class
is indexed: it lives in the inverted list of its best centroid as a residual
code and the norm of what the code leaves out. A vector x probes each list
whose centroid c is close to its best one b: x.(b - c) <= margin * |b - c|.
If y's best centroid is c, x.(b - c) + y.(c - b) = (x - y).(b - c), so the
smaller of the two terms is at most half of the right side, and either end
may find the pair. |x - y| is at most s = sqrt(2 - 2t) for partners at cosine
t, so margin = s / 2 finds every pair, whatever directions the vectors vary
in; the price is many probes where they vary evenly in many directions. In a list, distances to the codes come from
lookup tables (asymmetric); those that
could reach the threshold are ranked again by the exact cosine. What a code
leaves out adds at most the sum over subspaces of |x_m| times the left-out norm
there, which is an exact bound and never above |x| times the whole left-out norm.

Lists that are near each other form groups of GROUP_LISTS; a vector is sent
once to each group in which it probes a list, with one bit per list. Groups
with many members or probes are cut into blocks and paired block by
block, so no task holds a whole group. Tasks join links up as they find them, a
bounded number at a time, and return a degree and a local root for each vector,
never the pairs.

Defined cases: null vectors, empty or zero ones and those with null or
non-finite components link with nothing; vectors of different lengths don't
link; rows that repeat link with each other; a null id is a row like others,
and is not kept unless it is alone in its component; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .store import materialise, prepare

THRESHOLD = 0.9
SAMPLE_ROWS = 20_000
LIST_ROWS = 128
MAX_LISTS = 4096
SUBSPACES = 8
CODES = 256
GROUP_LISTS = 64
SLACK = 1e-7  # rounding of the probe test
TABLE_SLACK = 1e-5  # rounding of single-precision table sums of unit vectors
BLOCK_ROWS = 1 << 15
BLOCK_VALUES = 1 << 21  # components in a block: long vectors have blocks of fewer rows
QUERIES_AT_ONCE = 1024
FEW = 1 / 16  # up to this share of a part, the queries that ask a list are looked up one by one
PAIRS_AT_ONCE = 1 << 15


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        best = _nearest(x, centres)
        n = np.bincount(best, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres * centres).sum(1)
    return np.concatenate([(x[i:i + 4096] @ centres.T - half).argmax(1) for i in range(0, max(len(x), 1), 4096)])


def _near_order(centres: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``at`` in an order whose runs of GROUP_LISTS are near each other:
    halved along the widest direction, at whole runs."""
    if len(at) <= GROUP_LISTS:
        return at
    x = centres[at] - centres[at].mean(0)
    at = at[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
    half = -(-len(at) // (2 * GROUP_LISTS)) * GROUP_LISTS
    return np.concatenate([_near_order(centres, at[:half]), _near_order(centres, at[half:])])


class Index:
    """Coarse centroids and residual codebooks, fitted on unit vectors."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        lists = int(np.clip(rows // LIST_ROWS, 1, min(MAX_LISTS, max(1, len(sample) // 8))))
        self.centres = _kmeans(sample, lists, 6, rng)
        self.centres = self.centres[_near_order(self.centres, np.arange(lists))]
        residual = sample - self.centres[self.home(sample)]
        self.cuts = np.array_split(np.arange(d), min(SUBSPACES, d))
        self.books = [_kmeans(residual[:, c], min(CODES, len(sample)), 6, rng) for c in self.cuts]
        self.margin = (2 - 2 * threshold) ** 0.5 / 2

    @cached_property
    def apart(self) -> np.ndarray:
        """Distances of the centroids: made where they are needed, not sent."""
        square = (self.centres ** 2).sum(1)
        return np.sqrt(np.maximum(0, square[:, None] + square - 2 * self.centres @ self.centres.T))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "apart"}

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[i:i + 4096] @ self.centres.T).argmax(1) for i in range(0, max(len(x), 1), 4096)])

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The home list of each vector, and for each list whether it is probed."""
        dot = x @ self.centres.T
        home = dot.argmax(1)
        return home, dot.max(1)[:, None] - dot <= self.margin * self.apart[home] + SLACK

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        home, near = self.near(x)
        return home, [np.flatnonzero(r).astype(np.int32) for r in near]

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes and the norm of what they leave out."""
        codes = np.stack([_nearest(residual[:, c], b) for c, b in zip(self.cuts, self.books)], axis=1)
        return codes, np.sqrt((self.left_out(residual, codes) ** 2).sum(1))

    def left_out(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Norms of what the codes leave out, by subspace."""
        return self.norms(residual - np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1))

    def norms(self, x: np.ndarray) -> np.ndarray:
        """Norms of the parts of each row in the subspaces."""
        return np.stack([np.sqrt((x[:, c] ** 2).sum(1)) for c in self.cuts], axis=1)

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Dot products of all code words and the queries, by subspace."""
        return [(book @ queries[:, c].T).astype(np.float32) for c, book in zip(self.cuts, self.books)]

    def approximate(self, queries: np.ndarray, at: int, codes: np.ndarray, tables: list[np.ndarray] | None = None, rows: np.ndarray | None = None) -> np.ndarray:
        """Dot products of codes in list ``at`` and queries (those at ``rows``,
        or all) by table lookup."""
        tables = tables or self.tables(queries)
        x = queries if rows is None else queries[rows]
        out = np.repeat((x @ self.centres[at]).astype(np.float32)[None, :], len(codes), axis=0)
        for m, table in enumerate(tables):
            out += table.take(codes[:, m], axis=0) if rows is None else table[codes[:, m, None], rows]
        return out


def _bits(near: np.ndarray) -> np.ndarray:
    """Rows of bits, 8 bytes for each group of lists."""
    return np.packbits(np.pad(near, ((0, 0), (0, -near.shape[1] % GROUP_LISTS))), axis=1, bitorder="little")


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (of each node, the smallest one it is joined with) after the
    links a-b too."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up


def _unit(raw: list[bytes], dtype: np.dtype) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1)[:, None]  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1))[:, None]


def _links(classes: DataFrame, threshold: float, dtype: np.dtype) -> DataFrame:
    """(uid, linked, root) rows of classes with one vector length each; a
    class may have several rows, to be summed and joined up."""
    spark = classes.sparkSession
    rows = classes.count()
    sample = classes.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE_ROWS).select("raw").collect()
    index = Index(_unit([r.raw for r in sample], dtype), rows, threshold)
    shared = spark.sparkContext.broadcast(index)  # bounded by the sample

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for frame in frames:
            for i in range(0, len(frame), 2000):
                f = frame.iloc[i:i + 2000]
                home, near = index.near(_unit(f["raw"].tolist(), dtype))
                bits = _bits(near)
                asks = bits.reshape(len(f), -1, GROUP_LISTS // 8).any(2)
                yield f.assign(home=home.astype("int32"), probes=[r.tobytes() for r in bits], asks=[np.flatnonzero(r).astype(np.int32) for r in asks])

    placed = materialise(classes.select("uid", "n", "raw").mapInPandas(assign, "uid long, n long, raw binary, home int, probes binary, asks array<int>"), "vector-lists")
    placed = placed.withColumn("own", F.expr(f"home div {GROUP_LISTS}").cast("int"))
    # blocks of each group: a table with one row per group of at most MAX_LISTS lists
    asked = placed.select(F.explode("asks").alias("asked")).groupBy("asked").agg(F.count("*").alias("queries"))
    groups = placed.groupBy(F.col("own").alias("group")).agg(F.count("*").alias("members")).join(asked, F.col("group") == F.col("asked"))
    most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // index.centres.shape[1]))
    blocks = lambda n: F.expr(f"cast(({n} + {most - 1}) div {most} as int)")
    groups = F.broadcast(materialise(groups.select("group", blocks("members").alias("at"), blocks("queries").alias("wide")), "vector-blocks"))
    stored = placed.join(groups, F.col("own") == F.col("group")).select(
        "group", F.pmod("uid", "at").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("j"), F.lit(True).alias("member"),
        "uid", "n", "raw", "home", "probes")
    asking = placed.select("uid", "n", "raw", "home", "probes", F.explode("asks").alias("asked")).join(groups, F.col("asked") == F.col("group")).select(
        "group", F.explode(F.sequence(F.lit(0), F.col("at") - 1)).alias("i"), F.pmod("uid", "wide").cast("int").alias("j"), F.lit(False).alias("member"),
        "uid", "n", "raw", "home", F.expr(f"substring(probes, asked * {GROUP_LISTS // 8} + 1, {GROUP_LISTS // 8})").alias("probes"))

    def search(key, frame: pd.DataFrame) -> pd.DataFrame:
        index = shared.value
        m, q = frame[frame["member"]], frame[~frame["member"]].sort_values("home")  # vectors of one list probe much the same lists
        if m.empty or q.empty:
            return pd.DataFrame({"uid": pd.Series(dtype="int64"), "linked": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        x, y = _unit(q["raw"].tolist(), dtype), _unit(m["raw"].tolist(), dtype)
        lists = m["home"].to_numpy()
        codes, _ = index.encode(y - index.centres[lists])
        members = [(int(at), np.flatnonzero(lists == at)) for at in np.unique(lists)]
        uids = np.unique(np.concatenate([q["uid"].to_numpy(), m["uid"].to_numpy()]))
        qi, mi = np.searchsorted(uids, q["uid"].to_numpy()), np.searchsorted(uids, m["uid"].to_numpy())
        qn, mn = q["n"].to_numpy(), m["n"].to_numpy()
        homes = q["home"].to_numpy()
        asked = np.unpackbits(np.frombuffer(b"".join(q["probes"]), np.uint8).reshape(len(q), -1), axis=1, bitorder="little").astype(bool)
        known = np.frombuffer(b"".join(m["probes"]), np.uint8).reshape(len(m), -1)  # these lists the member asks by itself
        left, bits = index.left_out(y - index.centres[lists], codes).astype(np.float32), asked.T.copy()
        linked, root = np.zeros(len(uids), np.int64), np.arange(len(uids))
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def exact(r: np.ndarray, c: np.ndarray) -> None:
            hit = (np.einsum("ij,ij->i", x[r], y[c]) >= threshold) & (qi[r] != mi[c])
            r, c = r[hit], c[hit]
            np.add.at(linked, qi[r], mn[c])
            alone = (known[c, homes[r] >> 3] >> (homes[r] & 7)) & 1 == 0  # the member will not find this query
            np.add.at(linked, mi[c[alone]], qn[r[alone]])
            if len(r):
                waiting.append((qi[r], mi[c]))

        for a in range(0, len(x), QUERIES_AT_ONCE):
            part = x[a:a + QUERIES_AT_ONCE]
            tables, norms = index.tables(part), index.norms(part).astype(np.float32)
            for at, rows in members:
                asks = bits[at % GROUP_LISTS, a:a + QUERIES_AT_ONCE]
                some = np.flatnonzero(asks)
                if not len(some):
                    continue
                some = some if len(some) <= FEW * len(part) else None
                for k in range(0, len(rows), QUERIES_AT_ONCE):
                    here = rows[k:k + QUERIES_AT_ONCE]
                    most = index.approximate(part, at, codes[here], tables, some)
                    most += left[here] @ (norms if some is None else norms[some]).T
                    c, r = np.nonzero(most >= threshold - TABLE_SLACK)
                    r = r if some is None else some[r]
                    r, c = a + r[asks[r]], here[c[asks[r]]]
                    for k2 in range(0, len(r), PAIRS_AT_ONCE):
                        exact(r[k2:k2 + PAIRS_AT_ONCE], c[k2:k2 + PAIRS_AT_ONCE])
                        if sum(len(w[0]) for w in waiting) >= PAIRS_AT_ONCE:
                            root = _join(root, *map(np.concatenate, zip(*waiting)))
                            waiting.clear()
        if waiting:
            root = _join(root, *map(np.concatenate, zip(*waiting)))
        roots = uids[root]
        hit = (linked > 0) | (roots != uids)
        return pd.DataFrame({"uid": uids[hit], "linked": linked[hit], "root": roots[hit]})

    return stored.unionAll(asking).groupBy("group", "i", "j").applyInPandas(search, "uid long, linked long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id (the smallest id reachable by
    links, its own included) and kept."""
    spark = vectors.sparkSession
    prepare(spark)
    kind = dict(vectors.dtypes)[vector]
    single = kind == "array<float>"
    dtype = np.dtype("<f4" if single else "<f8")
    # + 0.0 makes both zeros one
    vec = F.transform(F.col(vector).cast("array<float>" if single else "array<double>"), lambda x: x + F.lit(0.0).cast("float" if single else "double"))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(F.col(vector), lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("vec_id"), F.when(F.coalesce(finite, F.lit(False)), vec).alias("vec"))
    classes = rows.where(F.col("vec").isNotNull()).groupBy("vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = materialise(classes.withColumn("uid", F.monotonically_increasing_id()), "vector-classes")

    def raw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(raw=[np.asarray(v, dtype).tobytes() for v in f["vec"]])[["uid", "n", "raw", "size"]]

    packed = materialise(classes.select("uid", "n", "vec", F.size("vec").alias("size")).mapInPandas(raw, "uid long, n long, raw binary, size int"), "vector-bytes")
    found = spark.createDataFrame([], "uid long, linked long, root long")
    for size in sorted(r["size"] for r in packed.select("size").distinct().collect()):  # vector lengths, as a rule one
        found = found.unionAll(_links(packed.where(F.col("size") == size).drop("size"), threshold, dtype))
    found = materialise(found, "vector-links")
    degrees = found.groupBy("uid").agg(F.sum("linked").alias("linked"))
    joined = connected(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    ids = classes.select("uid", "vec", "n", "least").join(degrees, "uid", "left").join(joined, F.col("uid") == F.col("node_"), "left")
    ids = ids.withColumn("component", F.coalesce("component", "uid"))
    ends = ids.groupBy("component").agg(F.min("least").alias("component_id")).withColumnRenamed("component", "_component")
    ids = ids.join(ends, F.col("component") == F.col("_component")).select(
        F.col("vec").alias("_vec"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(ids, F.col("vec") == F.col("_vec"), "left")
    component = F.when(F.col("_vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))
