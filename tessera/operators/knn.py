"""Exact k nearest neighbours with an index of blocks.

Donors are cut into cells: rows with the same missing-value pattern, split by
a k-d tree over that pattern's own columns into parts of about ``BLOCK_ROWS``
rows. The tree is grown from a bounded sample, so parts follow the density;
the box of a cell (least and greatest value of each column) comes from all its
rows. No donor of a cell is nearer to a query than the cell's box, in the
columns that both have, so a search takes two rounds:

1. each query goes to the cells whose boxes are nearest until they hold k
   donors for every value it asks for; this gives its k-th best distance;
2. it goes to every other cell whose box is not farther than that.

No more donors than ``DIRECT_CELLS`` cells hold are not indexed: each query
meets all of them. A pair
of a cell and its queries is one or more cogrouped tasks of at most about
``BLOCK_ROWS`` donors and as many queries, which return the k best of each
query; no pair table is shuffled and nothing passes through the driver but the
sample, the tree and one box per cell.

In the index, equal donors differ in their id alone and the smaller ids win, so only the
k + 1 smallest ids of equal donors are kept, and equal queries are searched
once: a value that a third of all rows share costs no more than another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import null_safe_join

BLOCK_ROWS = 10_000     # rows of a cell, and queries that meet a cell in one task
DONOR_BLOCK = 256       # donor rows per distance array
QUERY_BLOCK = 1_000     # query rows per distance array (QUERY_BLOCK x DONOR_BLOCK doubles)
SAMPLE_ROWS = 200_000   # rows that the tree is grown from, at most about
DIRECT_CELLS = 8
BOUND_CELLS = 250_000   # numbers of an array of bounds


def nan_dist(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """nan-Euclidean distances (queries x donors): sqrt(p / present * sum of
    squared differences over coordinates present in both); NaN if none."""
    p = q.shape[1]
    ssum = np.zeros((q.shape[0], d.shape[0]))
    present = np.zeros((q.shape[0], d.shape[0]))
    for j in range(p):
        diff = q[:, j][:, None] - d[:, j][None, :]
        ok = ~np.isnan(diff)
        ssum += np.where(ok, diff * diff, 0.0)
        present += ok
    with np.errstate(divide="ignore", invalid="ignore"):
        dist = np.sqrt((p / present) * ssum)
    dist[present == 0] = np.nan
    return dist


def _top_k(qx: np.ndarray, qids: np.ndarray, qmiss: dict, dx: np.ndarray, dids: np.ndarray, dvals: dict, targets: list[str],
           k: int) -> list[pd.DataFrame]:
    """The k nearest of some donors for each of some queries and each target.
    Queries are taken in blocks, so that the arrays don't follow their number."""
    if len(qids) > QUERY_BLOCK:
        blocks = [slice(lo, lo + QUERY_BLOCK) for lo in range(0, len(qids), QUERY_BLOCK)]
        return [f for b in blocks for f in _top_k(qx[b], qids[b], {t: m[b] for t, m in qmiss.items()}, dx, dids, dvals, targets, k)]
    best = {t: [] for t in targets}
    for lo in range(0, len(dids), DONOR_BLOCK):
        blk = slice(lo, lo + DONOR_BLOCK)
        dist = nan_dist(qx, dx[blk])
        for t in targets:
            dd = dist.copy()
            if t != "_all":
                dd[:, np.isnan(dvals[t][blk])] = np.nan       # donors must have the target feature
                dd[~qmiss[t], :] = np.nan                     # only rows missing it are filled
            dd = np.where(np.isnan(dd), np.inf, dd)
            # ids are sorted, so a stable sort breaks ties by the donor id
            pick = np.argsort(dd, axis=1, kind="stable")[:, :k]
            best[t].append((np.take_along_axis(dd, pick, 1), pick + lo))
    out = []
    for t in targets:
        dist = np.hstack([d for d, _ in best[t]])
        at = np.hstack([i for _, i in best[t]])
        pick = np.argsort(dist, axis=1, kind="stable")[:, :k]
        dist, at = np.take_along_axis(dist, pick, 1), np.take_along_axis(at, pick, 1)
        q, j = np.nonzero(np.isfinite(dist))
        value = dvals[t][at[q, j]] if t != "_all" else np.full(len(q), np.nan)
        out.append(pd.DataFrame({"_q": qids[q], "target": t, "did": dids[at[q, j]], "dist": dist[q, j], "value": value}))
    return out


# ------------------------------------------------------------------ the tree

@dataclass
class Tree:
    """Splits of one pattern: node i sends rows with x[dim] <= cut to ``low``,
    others to ``high``; a negative child is the part ~child."""

    dim: list[int]
    cut: list[float]
    low: list[int]
    high: list[int]
    root: int
    parts: int

    def part_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root)
        dim, cut, low, high = (np.array(a) for a in (self.dim, self.cut, self.low, self.high))
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            at[inner] = np.where(x[inner, dim[node]] <= cut[node], low[node], high[node])
        return ~at


def grow(sample: np.ndarray, parts: int) -> Tree:
    """Median splits of the widest column until there are ``parts`` parts, or
    the sample's rows are equal."""
    tree = Tree([], [], [], [], 0, 0)

    def node(rows: np.ndarray, wanted: int) -> int:
        spread = np.zeros(0)
        if wanted > 1 and len(rows) > 1:
            with np.errstate(invalid="ignore"):
                spread = np.nan_to_num(rows.max(axis=0) - rows.min(axis=0), nan=0.0)
        if not spread.size or spread.max() <= 0:
            tree.parts += 1
            return ~(tree.parts - 1)
        d = int(spread.argmax())
        values = np.sort(rows[:, d])
        cut = values[(len(values) * (wanted // 2)) // wanted - 1]
        if cut == values[-1]:  # many rows share the greatest value
            cut = values[np.searchsorted(values, cut) - 1]
        i = len(tree.dim)
        tree.dim.append(d)
        tree.cut.append(float(cut))
        tree.low.append(0)
        tree.high.append(0)
        below = rows[:, d] <= cut
        tree.low[i] = node(rows[below], wanted // 2)
        tree.high[i] = node(rows[~below], wanted - wanted // 2)
        return i

    tree.root = node(sample, parts)
    return tree


# ----------------------------------------------------------------- the cells

@dataclass
class Cells:
    """Per cell: its group, how many donors it has, its box (NaN where the
    pattern lacks the column) and for each target whether its donors have it."""

    group: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    has: dict[str, np.ndarray]

    def bounds(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Least possible distance of each query to a donor of each cell;
        infinite where they share no column."""
        gap2 = np.zeros((len(x), len(cells)))
        present = np.zeros((len(x), len(cells)))
        for j in range(x.shape[1]):
            q = x[:, j][:, None]
            gap = np.maximum(self.low[cells, j][None, :] - q, q - self.high[cells, j][None, :])
            ok = ~np.isnan(gap)
            gap2 += np.where(ok, np.maximum(gap, 0.0) ** 2, 0.0)
            present += ok
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.sqrt((x.shape[1] / present) * gap2)
        out[present == 0] = np.inf
        return out

    def first(self, bound: np.ndarray, cells: np.ndarray, wanted: dict[str, np.ndarray], k: int) -> np.ndarray:
        """The nearest cells of each query that together hold k donors of all it wants."""
        order = np.argsort(bound, axis=1, kind="stable")
        reached = np.zeros(len(bound), int)
        for t, asks in wanted.items():
            held = np.cumsum(np.where(np.isfinite(np.take_along_axis(bound, order, 1)), (self.rows[cells] * self.has[t][cells])[order], 0), axis=1)
            enough = held >= k
            upto = np.where(enough.any(axis=1), enough.argmax(axis=1), bound.shape[1] - 1)
            reached = np.maximum(reached, np.where(asks, upto, -1))
        mine = np.arange(bound.shape[1])[None, :] <= reached[:, None]
        out = np.zeros(bound.shape, bool)
        np.put_along_axis(out, order, mine, 1)
        return out & np.isfinite(bound)

    def routes(self, x: np.ndarray, group: np.ndarray, wanted: dict[str, np.ndarray], k: int,
               reach: dict[str, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, cell) numbers: of the first round, or with the k-th best
        distances ``reach`` of each target those of the second."""
        for g in pd.unique(group):
            cells = np.flatnonzero(self.group == g)
            rows = np.flatnonzero(group == g)
            step = max(1, BOUND_CELLS // max(1, len(cells)))
            for lo in range(0, len(rows) if len(cells) else 0, step):
                at = rows[lo:lo + step]
                bound = self.bounds(x[at], cells)
                asks = {t: w[at] for t, w in wanted.items()}
                chosen = self.first(bound, cells, asks, k)
                if reach is not None:
                    near = np.zeros(bound.shape, bool)
                    for t, w in asks.items():  # a hair of room for rounding; ties count, their ids may be smaller
                        near |= w[:, None] & self.has[t][cells][None, :] & (bound * (1 - 1e-9) <= reach[t][at][:, None])
                    chosen = near & ~chosen & np.isfinite(bound)
                q, c = np.nonzero(chosen)
                yield at[q], cells[c]


_NO_GROUP = "-"


def _group_key(group: list[str]):
    """The group as text, null included, so that it can be compared in Python."""
    if not group:
        return F.lit(_NO_GROUP)
    return F.coalesce(F.concat(F.lit("="), F.col(group[0]).cast("string")), F.lit("null"))


def _dealt(rows: DataFrame, own: str, key: str, n_own, other: str, n_other) -> DataFrame:
    """Rows dealt into ``n_own`` parts by a hash of ``key`` and copied to all
    ``n_other`` parts of the other side."""
    mine = F.pmod(F.xxhash64(key), n_own).cast("int")
    return rows.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), n_other - 1)))


def _meet(q: DataFrame, d: DataFrame, keys: list[str], cols: list[str], targets: list[str], k: int, id_col: str) -> DataFrame:
    """The k best donors of each query (``_q``) among those with its ``keys``."""
    named = d.columns
    d = d.select(*[F.col(c).alias(f"donor_{c}") for c in named])   # queries and donors may be the same table
    schema = f"_q {dict(q.dtypes)['_q']}, target string, did {dict(d.dtypes)[f'donor_{id_col}']}, dist double, value double"

    def run(qf: pd.DataFrame, df: pd.DataFrame) -> pd.DataFrame:
        frames = []
        if not qf.empty and not df.empty:
            df = df.set_axis(named, axis=1).sort_values(id_col)
            frames = _top_k(
                qf[cols].to_numpy(float), qf["_q"].to_numpy(), {t: np.isnan(qf[t].to_numpy(float)) for t in targets if t != "_all"},
                df[cols].to_numpy(float), df[id_col].to_numpy(), {t: df[t].to_numpy(float) for t in targets if t != "_all"}, targets, k)
        frames = [f for f in frames if len(f)]
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=["_q", "target", "did", "dist", "value"], dtype=object)

    return q.groupBy(*keys).cogroup(d.groupBy(*[f"donor_{c}" for c in keys])).applyInPandas(run, schema)


def _search(pairs: DataFrame, donors: DataFrame, cells: Cells, asked: dict[int, int], cols: list[str], targets: list[str], k: int, id_col: str,
            report: dict | None) -> DataFrame:
    """The k best of each query (``_q``) of ``pairs`` in the cell that it is sent to."""
    plan = [(c, max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(int(cells.rows[c]) / BLOCK_ROWS))) for c, n in asked.items()]
    if report is not None:
        report["distances"] = report.get("distances", 0) + sum(n * int(cells.rows[c]) for c, n in asked.items())
        report["shuffled"] = report.get("shuffled", 0) + sum(asked[c] * nd + int(cells.rows[c]) * nq for c, nq, nd in plan)
    parts = F.broadcast(pairs.sparkSession.createDataFrame(plan, "_cell int, _nq int, _nd int"))   # one row per cell
    q = _dealt(pairs.join(parts, "_cell"), "_a", "_q", F.col("_nq"), "_b", F.col("_nd")).drop("_nq", "_nd")
    d = _dealt(donors.join(parts, "_cell"), "_b", id_col, F.col("_nd"), "_a", F.col("_nq")).drop("_nq", "_nd")
    return _meet(q, d, ["_cell", "_a", "_b"], cols, targets, k, id_col)


def knn_search(queries: DataFrame, donors: DataFrame, id_col: str, cols: Sequence[str], k: int = 5,
               targets: Sequence[str] | None = None, exclude_self: bool = False, by: str | None = None,
               report: dict | None = None) -> DataFrame:
    """k nearest donors per query row (and per target column when given), ties
    by (distance, donor id): qid, target, did, dist, value, rank. Exact.
    ``by``: only donors with the query's value of this column count. A row
    without any of ``cols`` has no distances. ``report`` takes the number of
    computed distances and of rows sent to tasks."""
    from tessera.session import cut_lineage, ship_package

    spark = donors.sparkSession
    ship_package(spark)
    cols, tgt = list(cols), list(targets) if targets else ["_all"]
    need = list(dict.fromkeys([*cols, *(targets or [])]))
    group = [by] if by else []
    kk = k + 1 if exclude_self else k

    def read(d: DataFrame, *more: str) -> DataFrame:
        num = {c: F.col(c).cast("double") for c in need}
        return d.select(*more, *group, *[F.when(~F.isnan(v), v).alias(c) for c, v in num.items()]).where(
            F.coalesce(*cols).isNotNull())

    def final(found: DataFrame) -> DataFrame:
        if exclude_self:
            found = found.where(F.col("qid") != F.col("did"))
        w = Window.partitionBy("qid", "target").orderBy("dist", "did")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    n_donors = donors.count()
    if n_donors <= DIRECT_CELLS * BLOCK_ROWS:   # every query meets every block
        n_queries = queries.count()
        nq, nd = (F.lit(max(1, math.ceil(n / BLOCK_ROWS))) for n in (n_queries, n_donors))
        if report is not None:
            report.update(distances=n_queries * n_donors, shuffled=n_queries + n_donors)
        q = _dealt(read(queries, id_col).withColumnRenamed(id_col, "_q"), "_a", "_q", nq, "_b", nd)
        d = _dealt(read(donors, id_col), "_b", id_col, nd, "_a", nq)
        return final(_meet(q, d, [*group, "_a", "_b"], cols, tgt, kk, id_col).withColumnRenamed("_q", "qid"))

    # ---- donors: of equal ones the smallest ids, each with its pattern
    same = Window.partitionBy(*group, *need).orderBy(id_col)
    d = read(donors, id_col).withColumn("_rn", F.row_number().over(same)).where(F.col("_rn") <= kk).drop("_rn")
    bits = sum((F.col(c).isNotNull().cast("long") * (1 << i) for i, c in enumerate(need)), F.lit(0))
    d = cut_lineage(d.withColumns({"_pattern": bits, "_group": _group_key(group)}))
    boxes = [F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_lo{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(cols)]]
    per_pattern = {r["_pattern"]: r["count"] for r in d.groupBy("_pattern").count().collect()}   # one row per pattern
    total = sum(per_pattern.values())
    sample = d.select("_pattern", *cols).sample(min(1.0, SAMPLE_ROWS / max(total, 1)), seed=1).toPandas()
    trees, first = {}, 0
    for pattern, n in sorted(per_pattern.items()):
        own = sample.loc[sample["_pattern"] == pattern, cols].to_numpy(float)
        trees[pattern] = (grow(own, math.ceil(n / BLOCK_ROWS)), first)
        first += trees[pattern][0].parts

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, pattern, part = f[cols].to_numpy(float), f["_pattern"].to_numpy(), np.zeros(len(f), np.int64)
            for p in np.unique(pattern):
                tree, at = trees[p]
                rows = np.flatnonzero(pattern == p)
                part[rows] = at + tree.part_of(x[rows])
            yield f.assign(_part=part)

    d = cut_lineage(d.mapInPandas(place, T.StructType([*d.schema.fields, T.StructField("_part", T.LongType())])))
    table = d.groupBy("_group", "_pattern", "_part").agg(*boxes).collect()   # one row per cell
    box = lambda side: np.array([[np.nan if r[f"_{side}{i}"] is None else r[f"_{side}{i}"] for i in range(len(cols))] for r in table]).reshape(-1, len(cols))
    pattern = np.array([r["_pattern"] for r in table], np.int64)
    cells = Cells(np.array([r["_group"] for r in table], object), np.array([r["_n"] for r in table], np.int64), box("lo"), box("hi"),
                  {t: np.ones(len(table), bool) if t == "_all" else (pattern >> need.index(t)) & 1 == 1 for t in tgt})
    numbered = spark.createDataFrame([(r["_group"], r["_part"], i) for i, r in enumerate(table)], "_group string, _part long, _cell int")
    d = d.join(F.broadcast(numbered), ["_group", "_part"]).select("_cell", id_col, *need)

    # ---- queries: equal ones once
    q = read(queries).distinct().withColumns({"_q": F.monotonically_increasing_id(), "_group": _group_key(group)})
    q = cut_lineage(q)
    wants = lambda f: {t: np.ones(len(f), bool) if t == "_all" else np.isnan(f[t].to_numpy(float)) for t in tgt}
    send_schema = f"_q long, _cell int, {', '.join(f'`{c}` double' for c in need)}"

    def sent(frames: Iterator[pd.DataFrame], reaching: bool) -> Iterator[pd.DataFrame]:
        for f in frames:
            far = {t: f[f"_u{i}"].fillna(np.inf).to_numpy(float) for i, t in enumerate(tgt)} if reaching else None
            for rows, cell in cells.routes(f[cols].to_numpy(float), f["_group"].to_numpy(object), wants(f), kk, far):
                if len(rows):
                    yield f.iloc[rows][["_q", *need]].assign(_cell=cell.astype(np.int32))[["_q", "_cell", *need]]

    def routed(rows: DataFrame, reaching: bool) -> tuple[DataFrame, dict[int, int]]:
        pairs = cut_lineage(rows.mapInPandas(lambda frames: sent(frames, reaching), send_schema))
        return pairs, {r["_cell"]: r["count"] for r in pairs.groupBy("_cell").count().collect()}   # one row per cell

    order = Window.partitionBy("_q", "target").orderBy("dist", "did")
    best_of = lambda c: c.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kk)
    pairs, asked = routed(q, False)
    best = cut_lineage(best_of(_search(pairs, d, cells, asked, cols, tgt, kk, id_col, report)))
    reach = best.where(F.col("rank") == kk).groupBy("_q").agg(
        *[F.max(F.when(F.col("target") == t, F.col("dist"))).alias(f"_u{i}") for i, t in enumerate(tgt)])
    pairs, asked = routed(q.join(reach, "_q", "left"), True)
    best = best_of(best.drop("rank").unionByName(_search(pairs, d, cells, asked, cols, tgt, kk, id_col, report)))

    # ---- every query row gets the neighbours of its values
    rows = null_safe_join(read(queries, id_col).withColumnRenamed(id_col, "qid"), q.select(*group, *need, "_q"), [*group, *need])
    return final(rows.select("qid", "_q").join(best.drop("rank"), "_q").drop("_q"))
