"""Catalog: machine-learning preparation and models M1-M11 (the
prediction pipeline on the labelled-documents table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.common import T, V, W
from tessera.operators import ml as M
from tessera.operators.frame import dedup
from tessera.operators.reshape import dummies
from tessera.session import cut_lineage

SEED = 42
NUM = ["n_chars", "spaces"]
#: The languages of the table: levels are part of the schema, not fitted.
LEVELS = {"lang": ["de", "en", "es", "fr"]}


def m1_knn_impute(spark, sf):
    return M.knn_impute(V(spark, sf, "v_part_gaps"), "id", ["f1", "f2"], k=5)


def m2_mode_impute(spark, sf):
    return M.mode_impute(V(spark, sf, "v_orders_gaps"), ["priority"]).select("o_orderkey", "priority")


def m3_minmax(spark, sf):
    return M.minmax(T(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])


def _prepared(spark, sf):
    """Scale numeric features, one-hot the language, drop duplicate rows."""
    d = V(spark, sf, "v_labelled")
    d = M.minmax(d, NUM)
    d = dummies(d, ["lang"])
    return dedup(d)


def _features(df):
    return [c for c in df.columns if c in NUM or c.startswith("lang_")]


def m4_smote(spark, sf):
    d = _prepared(spark, sf)
    return M.smote(d, "doc_id", "label", _features(d), k=5, seed=SEED)


def m5_split(spark, sf):
    return M.split(V(spark, sf, "v_labelled"), "doc_id", 0.2, SEED).select("doc_id", "is_test")


def m6_fit_logistic(spark, sf):
    d = _prepared(spark, sf)
    cols = _features(d)
    model = M.fit_logistic(d, cols, "label")
    rows = [("(Intercept)", float(model.intercept))] + [(c, float(w)) for c, w in zip(cols, model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, weight double")


def _rule(spark, sf):
    d = V(spark, sf, "v_labelled")
    return d.withColumn("prediction", (F.col("n_chars") > 2000).cast("int"))


def m7_confusion(spark, sf):
    return M.confusion(_rule(spark, sf), "label", "prediction")


def m8_accuracy(spark, sf):
    return M.accuracy(_rule(spark, sf), "label", "prediction")


def _raw(spark, sf):
    """One-hot the language, drop duplicate rows; nothing is fitted yet."""
    return dedup(dummies(V(spark, sf, "v_labelled"), ["lang"], levels=LEVELS))


def _holdout(spark, sf, components: int = 0):
    """Split, scale (and find components) by the training rows, balance the
    training split, fit, score the test split. The split rows are read by many
    jobs: written once to the checkpoint folder."""
    d = cut_lineage(M.split(_raw(spark, sf), "doc_id", 0.2, SEED))
    cols = _features(d)
    d = M.minmax(d, NUM, fit_on=d.where(F.col("is_test") == 0))
    if components:
        k = min(components, len(cols))
        d = M.pca(d, cols, k, fit_on=d.where(F.col("is_test") == 0))
        cols = [f"PCA_{i}" for i in range(1, k + 1)]
    train = M.smote(d.where(F.col("is_test") == 0).select("doc_id", "label", *cols), "doc_id", "label", cols,
                    k=5, seed=SEED)
    intercept, weights = M.fit_newton(cut_lineage(train), cols, "label")
    r = M.accuracy(M.predict_linear(d.where(F.col("is_test") == 1), cols, intercept, weights), "label").first()
    return spark.createDataFrame([(r["accuracy"], r["n"])], "accuracy double, n long")


def m8_holdout_accuracy(spark, sf):
    return _holdout(spark, sf)


def m9_pca(spark, sf):
    e = T(spark, sf, "embeddings")
    return M.pca(e, "embedding", 5).select("vec_id", *[f"PCA_{i}" for i in range(1, 6)])


def m9_pca_holdout_accuracy(spark, sf):
    return _holdout(spark, sf, 5)


def m11_cross_validate_pca(spark, sf):
    d = _raw(spark, sf)
    return M.cross_validate(d, "doc_id", _features(d), "label", 5, scale=NUM, n_components=5)


def m10_stratified_folds(spark, sf):
    return M.stratified_folds(V(spark, sf, "v_labelled"), "doc_id", "label", 5).select("doc_id", "label", "fold")


def m11_cross_validate(spark, sf):
    d = _raw(spark, sf)
    return M.cross_validate(d, "doc_id", _features(d), "label", 5, scale=NUM)


QUERIES = {k: v for k, v in globals().items() if k[:1] == "m" and k[1:2].isdigit() and callable(v)}

ORACLE = {
    "m1_knn_impute": W("""
with g as (select * from v_part_gaps where f1 is null or f2 is null),
p as (select g.id as qid, d.id as did, g.f1 as qf1, g.f2 as qf2, d.f1 as df1, d.f2 as df2,
  (case when g.f1 is not null and d.f1 is not null then 1 else 0 end) + (case when g.f2 is not null and d.f2 is not null then 1 else 0 end) as present,
  coalesce((g.f1 - d.f1) * (g.f1 - d.f1), 0) + coalesce((g.f2 - d.f2) * (g.f2 - d.f2), 0) as ssum
  from g join v_part_gaps d on g.id <> d.id),
q as (select *, sqrt((2.0 / present) * ssum) as dist from p where present > 0),
t1 as (select qid, avg(df1) as fill_f1 from (select qid, df1, row_number() over (partition by qid order by dist, did) as rk
  from q where qf1 is null and df1 is not null) where rk <= 5 group by qid),
t2 as (select qid, avg(df2) as fill_f2 from (select qid, df2, row_number() over (partition by qid order by dist, did) as rk
  from q where qf2 is null and df2 is not null) where rk <= 5 group by qid)
select v.id, coalesce(v.f1, t1.fill_f1, (select avg(f1) from v_part_gaps)) as f1,
  coalesce(v.f2, t2.fill_f2, (select avg(f2) from v_part_gaps)) as f2
from v_part_gaps v left join t1 on v.id = t1.qid left join t2 on v.id = t2.qid""", "v_part_gaps"),
    "m2_mode_impute": W("""select o_orderkey, coalesce(priority, (select priority from v_orders_gaps where priority is not null
  group by priority order by count(*) desc, priority limit 1)) as priority from v_orders_gaps""", "v_orders_gaps"),
    "m3_minmax": """select p_partkey,
  case when max(p_size) over () > min(p_size) over () then (p_size - min(p_size) over ()) / (max(p_size) over () - min(p_size) over ())
    else 0.0 end as p_size,
  case when max(p_retailprice) over () > min(p_retailprice) over () then (p_retailprice - min(p_retailprice) over ()) /
    (max(p_retailprice) over () - min(p_retailprice) over ()) else 0.0 end as p_retailprice from part""",
    "m5_split": W("""select doc_id, cast(row_number() over (order by md5('42:' || cast(doc_id as varchar))) <= ceil(0.2 * count(*) over ()) as int)
  as is_test from v_labelled""", "v_labelled"),
    "m7_confusion": W("""select label as truth, cast(count(*) filter (where n_chars <= 2000) as bigint) as pred_0,
  cast(count(*) filter (where n_chars > 2000) as bigint) as pred_1 from v_labelled group by label""", "v_labelled"),
    "m8_accuracy": W("""select avg(case when label = (case when n_chars > 2000 then 1 else 0 end) then 1.0 else 0.0 end) as accuracy,
  cast(count(*) as bigint) as n from v_labelled""", "v_labelled"),
    "m10_stratified_folds": W("""
with c as (select label, count(*) as n, min(doc_id) as f from v_labelled group by label),
s as (select label, cast(n as bigint) as n, cast(coalesce(sum(n) over (order by f rows between unbounded preceding and 1 preceding), 0) as bigint) as st from c),
a as (select s.label, f.f, (select count(*) from range(s.st, s.st + s.n) t(p) where p % 5 = f.f) as alloc
  from s, (select range as f from range(5)) f),
cu as (select label, f, sum(alloc) over (partition by label order by f) as cum from a),
r as (select doc_id, label, row_number() over (partition by label order by doc_id) - 1 as i from v_labelled)
select r.doc_id, r.label, cast((select count(*) from cu where cu.label = r.label and cu.cum <= r.i) as int) as fold from r""",
                               "v_labelled"),
}
