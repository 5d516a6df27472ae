"""Machine-learning preparation and models M1-M11.

Scale notes
-----------
* ``rank.row_index`` numbers rows exactly in key order without a
  single-partition window (range buckets + per-bucket windows + bucket
  offsets). The split (M5), the stratified folds (M10) and SMOTE's copy
  counts (M4) are built on it.
* k-nearest-neighbour search (M1, M4) is ``knn.knn_search``: an index of
  blocks, so a query meets only blocks that can hold a nearer donor.
* Model fitting uses ``pyspark.ml`` (distributed L-BFGS, PCA on a distributed
  covariance); folds and hold-out use ``folds``: moments of all folds from one
  pass, Newton steps for all models at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import folds
from tessera.operators.knn import knn_search
from tessera.operators.rank import row_index  # noqa: F401  (exact distributed row numbers)


# ------------------------------------------------------------ row numbering


def hash_key(id_col: str, seed: int, *extra) -> F.Column:
    """Seeded pseudo-random long per row, stable under re-partitioning."""
    return F.xxhash64(F.col(id_col), F.lit(seed), *[F.lit(e) for e in extra])


def md5_key(id_col: str, seed: int) -> F.Column:
    """The first 52 bits of md5("seed:id"): a seeded draw that any SQL engine
    can repeat."""
    text = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


# --------------------------------------------------------------------- k-NN


def knn_impute(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 5) -> DataFrame:
    """M1: k-NN imputation (uniform weights). For each missing cell, the mean
    of the target feature over the k nearest rows that have it, by
    nan-Euclidean distance over features present in both; no eligible donor
    -> the column mean."""
    cols = list(cols)
    # NaN counts as missing, as in the distances
    num = {c: F.col(c).cast("double") for c in cols}
    clean = df.withColumns({c: F.when(F.isnan(v), F.lit(None)).otherwise(v) for c, v in num.items()})
    any_gap = None
    for c in cols:
        e = F.col(c).isNull()
        any_gap = e if any_gap is None else any_gap | e
    gaps = clean.where(any_gap)
    nn = knn_search(gaps, clean, id_col, cols, k, targets=cols, exclude_self=True)
    fill = nn.groupBy("qid").pivot("target", cols).agg(F.avg("value"))
    fill = fill.select(F.col("qid").alias(id_col), *[F.col(c).alias(f"_fill_{c}") for c in cols])
    means = clean.agg(*[F.avg(c).alias(c) for c in cols]).first()
    out = clean.join(fill, id_col, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_fill_{c}"), F.lit(means[c])).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


# ------------------------------------------------------- simple preparation


def mode_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M2: fill missing values with the column's most frequent value (ties:
    lowest value). The modes are scalar subqueries (one value each)."""
    modes = {}
    for c in cols:
        # counts per value (distributed, map-side combined), then the most
        # frequent value, lowest on ties, as a scalar subquery
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        modes[c] = counts.select(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c)))).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), modes[c]) for c in cols})


def minmax(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M3: (x - min) / (max - min) per column; a constant column gives 0.
    Minima and maxima are scalar subqueries over one shared scan of ``fit_on``
    (e.g. the training split; ``df`` itself by default)."""
    out, src = {}, df if fit_on is None else fit_on
    for c in cols:
        lo = src.select(F.min(F.col(c).cast("double"))).scalar()
        hi = src.select(F.max(F.col(c).cast("double"))).scalar()
        rng = hi - lo
        out[c] = F.when(rng > 0, (F.col(c).cast("double") - lo) / rng).when(F.col(c).isNotNull(), F.lit(0.0))
    return df.withColumns(out)


def split(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """M5: seeded exact train/test split: rows ranked by ``md5_key`` of the id;
    the first ceil(test * n) are the test set. Stable under re-partitioning."""
    n = df.count()
    n_test = math.ceil(test * n)
    r = row_index(df.withColumn("_h", md5_key(id_col, seed)), "_h", out="_i")
    return r.withColumn(out, (F.col("_i") < n_test).cast("int")).drop("_h", "_i")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled stratified k folds: classes in order of their first
    appearance (smallest id), dealt to folds round-robin to get each class's
    fold sizes; within a class, rows in id order fill fold 0, then fold 1, ...
    (contiguous blocks). A missing label is a class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("f")).orderBy("f").collect()   # one row per class
    bounds, start = {}, 0
    for cls, n, _ in counts:
        # the classes dealt round-robin: class positions [start, start + n)
        alloc = [len(range(start + ((f - start) % k), start + n, k)) for f in range(k)]
        cum = list(np.cumsum(alloc))
        bounds[cls] = cum
        start += n
    idx = row_index(df, id_col, by=[label], out="_i")
    expr = None
    for cls, cum in bounds.items():
        arr = F.array(*[F.lit(int(x)) for x in cum])
        f = F.size(F.filter(arr, lambda b: b <= F.col("_i")))
        mine = F.col(label).eqNullSafe(F.lit(cls))
        expr = F.when(mine, f) if expr is None else expr.when(mine, f)
    return idx.withColumn(out, (expr if expr is not None else F.lit(None)).cast("int")).drop("_i")


def smote(df: DataFrame, id_col: str, label: str, cols: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """M4: SMOTE oversampling of every class to the largest class's count.

    Each synthetic row is x + u * (neighbour - x) with the neighbour one of x's
    k nearest rows of its class and u in [0, 1) -- both drawn from seeded
    hashes of (id, copy), so the result does not depend on partitioning.
    Copies are spread evenly over a class's rows; the remainder goes to the
    rows first in seeded-hash order (exact count via ``row_index``). Output:
    the original rows (``copy`` 0) and synthetic ones (``copy`` from 1, the id
    of the row they start from; ``synthetic`` = 1). Raises where a class to be
    raised has one row. Rows without a label are passed on."""
    from tessera.session import cut_lineage

    cols = list(cols)
    base = df.select(id_col, *cols, label, F.lit(0).alias("synthetic"), F.lit(0).alias("copy"))
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    largest = counts.agg(F.max("_n")).first()[0] or 0
    lone = counts.where((F.col("_n") < 2) & (F.col("_n") < largest)).first()
    if lone:
        raise ValueError(f"class {lone['_class']!r} has one row: nothing to interpolate with")
    # the rows to copy are read by the k-NN search, the copy numbering and the
    # joins: write them once to the shared checkpoint folder and cut the lineage
    few = counts.where(F.col("_n") < largest)
    mino = df.select(id_col, *cols, label).join(few, F.col(label) == F.col("_class")).drop("_class")
    mino = cut_lineage(mino)
    nn = knn_search(mino, mino, id_col, cols, k, exclude_self=True, by=label).select(
        F.col("qid").alias(id_col), F.col("rank"), F.col("did"))
    ranked = row_index(mino.withColumn("_h", hash_key(id_col, seed)), "_h", by=[label], out="_i")
    wanted = F.lit(largest) - F.col("_n")
    per = F.floor(wanted / F.col("_n"))
    copies = ranked.withColumn("_c", (per + (F.col("_i") < wanted - per * F.col("_n")).cast("int")).cast("int")).where(F.col("_c") > 0)
    ex = copies.select(id_col, *cols, label, F.explode(F.sequence(F.lit(0), F.col("_c") - 1)).alias("_copy"))
    n_nb = nn.groupBy(id_col).agg(F.max("rank").alias("_nn"))
    ex = ex.join(n_nb, id_col)
    pick = (F.pmod(hash_key(id_col, seed, 1) + F.col("_copy"), F.col("_nn")) + 1).cast("int")
    u = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.col("_copy"), F.lit(2)), F.lit(1 << 30)) / float(1 << 30))
    ex = ex.withColumns({"rank": pick, "_u": u}).join(nn, [id_col, "rank"])
    nb = mino.select(F.col(id_col).alias("did"), *[F.col(c).alias(f"_nb_{c}") for c in cols])
    ex = ex.join(nb, "did")
    syn = ex.select(
        id_col, *[(F.col(c) + F.col("_u") * (F.col(f"_nb_{c}") - F.col(c))).alias(c) for c in cols], label,
        F.lit(1).alias("synthetic"), (F.col("_copy") + 1).cast("int").alias("copy"))
    return base.unionByName(syn)


# ------------------------------------------------------------------ models


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def fit_logistic(train: DataFrame, cols: Sequence[str], label: str, C: float = 1.0, max_iter: int = 100):
    """M6: L2 logistic regression matching an objective C * sum(logloss) +
    ||w||^2 / 2 (intercept unpenalised): regParam = 1 / (C n), no
    standardisation. Returns the fitted ``pyspark.ml`` model."""
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=1e-6)
    return lr.fit(assemble(train, cols).withColumn(label, F.col(label).cast("double")))


def predict(model, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Threshold-0.5 class predictions as an int column ``prediction``."""
    return model.transform(assemble(df, cols)).withColumn("prediction", F.col("prediction").cast("int")).drop(
        "features", "rawPrediction", "probability")


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              classes: Sequence[int] | None = None) -> DataFrame:
    """M7: confusion matrix, rows = truth, one column per predicted class,
    zero-filled, a row also for classes that no row has. The classes are
    all labels and predictions of the data and those given."""
    pairs = pred.groupBy(F.col(label).cast("int").alias("truth"), F.col(prediction).cast("int").alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    seen = pairs.select(F.explode(F.array("truth", "guess")).alias("c")).where(F.col("c").isNotNull()).distinct()
    classes = sorted({*(classes or []), *(r["c"] for r in seen.collect())})   # one row per class
    grid = pred.sparkSession.createDataFrame([(c,) for c in classes], "truth int")
    wide = pairs.groupBy("truth").pivot("guess", classes).agg(F.sum("n"))
    return (grid.join(wide, "truth", "left").na.fill(0)
            .select("truth", *[F.col(str(c)).cast("bigint").alias(f"pred_{c}") for c in classes]))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M8: share of rows predicted right (one row)."""
    return pred.agg(F.avg((F.col(label).cast("int") == F.col(prediction).cast("int")).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).cast("bigint").alias("n"))


def pca(df: DataFrame, cols: Sequence[str] | str, n: int = 5, prefix: str = "PCA_",
        fit_on: DataFrame | None = None) -> DataFrame:
    """M9: principal components appended as ``PCA_1..n``. Inputs are centred
    first; each component's sign is fixed so its largest-magnitude loading is
    positive. ``cols`` is a list of numeric columns (moments in one pass, see
    ``folds``; applied as expressions) or the name of one array/vector column
    (``pyspark.ml``). ``fit_on`` (e.g.
    the training split) gives the rows the centring and the components are
    fitted on; they are then applied to every row of ``df``."""
    if not isinstance(cols, str):
        m = folds.moments(fit_on if fit_on is not None else df, cols)
        if not m:
            return df.withColumns({f"{prefix}{j + 1}": F.lit(None).cast("double") for j in range(n)})
        return folds.apply(df, cols, folds.prepared(m[-1], cols, n_components=n), [f"{prefix}{j + 1}" for j in range(n)])

    def vectors(d: DataFrame) -> DataFrame:
        dtype = dict(d.dtypes)[cols]
        return d.withColumn("_x", F.col(cols) if dtype == "vector" else array_to_vector(F.col(cols).cast("array<double>")))

    d = vectors(df)
    fit_rows = vectors(fit_on) if fit_on is not None else d
    sc = StandardScaler(inputCol="_x", outputCol="_xc", withMean=True, withStd=False).fit(fit_rows)
    model = PCA(k=n, inputCol="_xc", outputCol="_pc").fit(sc.transform(fit_rows))
    pc = model.pc.toArray()                       # p x n loadings (small)
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(n)]
    out = model.transform(sc.transform(d)).withColumn("_a", vector_to_array("_pc"))
    out = out.withColumns({f"{prefix}{j + 1}": F.col("_a")[j] * F.lit(signs[j]) for j in range(n)})
    return out.drop("_x", "_xc", "_pc", "_a")


def cross_validate(df: DataFrame, id_col: str, cols: Sequence[str], label: str, k: int = 5,
                   C: float = 1.0, scale: Sequence[str] = (), n_components: int = 0) -> DataFrame:
    """K-fold cross-validated accuracy (stratified, unshuffled folds):
    per-fold accuracy plus the mean and the population std (as numpy's
    ``std``). Columns of ``scale`` are min-max scaled and ``n_components``
    components taken as the training rows of each fold have them. All folds
    are fitted at once (see ``folds``): the number of jobs doesn't depend on
    k. Labels are 0 and 1; rows without one are left out."""
    from tessera.session import cut_lineage

    # read by every pass: a reliable checkpoint in the shared checkpoint
    # folder, so a lost executor costs a re-read, not the whole prep lineage
    f = cut_lineage(stratified_folds(df.where(F.col(label).isNotNull()), id_col, label, k).select("fold", label, *cols))
    seen = folds.moments(f, cols, "fold")
    models = {i: folds.prepared(m, cols, scale, n_components) for i, m in seen.items() if i >= 0}
    fits = folds.newton(f, cols, label, models, C, "fold")
    right = folds.scores(f, cols, label, models, fits, "fold") if models else {}
    rows = [(i, r / n, n) for i, (n, r) in sorted(right.items())]
    accs = np.array([r[1] for r in rows])
    per = df.sparkSession.createDataFrame(rows, "fold int, accuracy double, n long")
    return per.withColumns({"mean_accuracy": F.lit(float(accs.mean()) if rows else None).cast("double"),
                            "std_accuracy": F.lit(float(accs.std()) if rows else None).cast("double")})


def fit_newton(train: DataFrame, cols: Sequence[str], label: str, C: float = 1.0) -> tuple[float, list[float]]:
    """M6 by Newton steps: (intercept, weights), the same minimum as
    ``fit_logistic``. The input is read once a step: give it materialised."""
    plain = folds.Affine(np.eye(len(cols)), np.zeros(len(cols)))
    intercept, w = folds.newton(train, cols, label, {-1: plain}, C)[-1]
    return intercept, w.tolist()


def predict_linear(df: DataFrame, cols: Sequence[str], intercept: float, weights: Sequence[float]) -> DataFrame:
    """Threshold-0.5 predictions of a logistic regression as an expression."""
    score = sum((F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights)), F.lit(float(intercept)))
    return df.withColumn("prediction", (score > 0).cast("int"))
