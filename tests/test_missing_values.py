"""Missing keys and values, ties and collinear columns: one test for each
operator whose plain form would drop or change such rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import frame, joins, knn, ml, ordered, rank, reshape, stats
from tessera.session import ensure_checkpoint_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_winsorize_keeps_missing_values_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (1, None), (1, 5.0), (1, 6.0), (1, 100.0)], "g int, v double")
    out = {(r.g, r.v): r.v_w for r in ordered.winsorize(df, "g", "v", 0.25).collect()}
    assert out[1, None] is None and out[None, 1.0] == 1.0 and out[1, 100.0] < 100


def test_quantile_groups_keep_null_periods(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 1.0), (1, 2.0), (1, None), (None, None)], "p int, v double")
    for method in ("ntile", "rank"):
        got = {(r.p, r.v): r.grp for r in ordered.quantile_groups(df, "p", "v", 2, method).collect()}
        assert got == {(None, 1.0): 1, (None, 2.0): 2, (1, 1.0): 1, (1, 2.0): 2, (1, None): None, (None, None): None}


def test_first_flag_of_a_null_entity(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1), (3, None)], "e int, o int")
    assert rows(ordered.first_flag(df, "e", "o")) == [(3, 1, 0), (3, None, 1), (None, 1, 1), (None, 2, 0)]


def test_lag_without_reset_over_text_and_null_entities(spark):
    df = spark.createDataFrame([("b", 1, 10), ("b", 2, 20), ("a", 1, 5), (None, 1, 7), ("c", 9, None), ("d", 1, 1)], "e string, o int, v int")
    got = {(r.e, r.o): r.v_lag1 for r in ordered.lag_by(df, "e", "o", "v", reset=False).collect()}
    assert got == {(None, 1): None, ("a", 1): 7, ("b", 1): 5, ("b", 2): 10, ("c", 9): 20, ("d", 1): None}


def test_row_index_puts_missing_keys_first(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 3.0), (2, float("nan")), (2, 5.0), (2, None)], "g int, k double")
    got = {(r.g, str(r.k)): r.idx for r in rank.row_index(df, "k", by=["g"]).collect()}
    assert got == {(None, "None"): 0, (None, "1.0"): 1, (None, "3.0"): 2, (2, "None"): 0, (2, "5.0"): 1, (2, "nan"): 2}


def test_drop_last_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None)], "a int, b int")
    assert rows(frame.drop_last(df, ["a", "b"], 2)) == [(None, 1)]
    assert frame.drop_last(df, ["a", "b"], 3).count() == 0


def test_duplicate_count_of_an_empty_table(spark):
    assert rows(frame.duplicate_count(spark.createDataFrame([], "a int"))) == [(0, 0, 0)]


def test_join_then_first_takes_the_first_row_with_a_match(spark):
    fine = spark.createDataFrame([("k", 1, 10), ("k", 2, 20), ("j", 3, 1)], "k string, m int, t int")
    coarse = spark.createDataFrame([(2, "x")], "m int, c string")
    assert rows(joins.join_then_first(fine, coarse, ["m"], ["k"], ["t"]).select("k", "m", "t", "c")) == [("k", 2, 20, "x")]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    b = spark.createDataFrame([(None, 8), (2, 9)], "k int, y int")
    assert rows(joins.null_safe_join(a, b, ["k"])) == [(2, 2, 9), (None, 1, 8)]
    assert joins.null_safe_join(a, b.where("k is null"), ["k"], "left_anti").count() == 1


def test_complete_entities_by_present_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, 1.0), ("b", 2, 2.0), ("c", 1, 1.0), ("c", 2, float("nan")), (None, 1, 1.0), (None, 2, 1.0)],
                               "e string, p int, v double")
    kept = {r.e for r in reshape.complete_entities(df, ["e"], "p", measure="v").collect()}
    assert kept == {"b", None}
    assert {r.e for r in reshape.complete_entities(df, ["e"], "p").collect()} == {"a", "b", "c", None}


def test_correlation_test_of_a_perfect_line(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "x double, y double")
    r = stats.corr_test(df, "x", "y").first()
    assert r.t == math.inf and r.p == 0.0 and r.r == pytest.approx(1.0)
    r = stats.corr_test(df.withColumn("y", -F.col("y")), "x", "y", conf=0.8).first()
    assert r.t == -math.inf and r.p == 0.0
    noisy = spark.createDataFrame([(float(i), float(i % 3)) for i in range(20)], "x double, y double")
    wide, narrow = (stats.corr_test(noisy, "x", "y", conf=c).first() for c in (0.95, 0.5))
    assert wide.ci_lo < narrow.ci_lo < narrow.r < narrow.ci_hi < wide.ci_hi


def test_nearly_collinear_columns_are_estimated_and_equal_ones_are_not(spark):
    rng = np.random.default_rng(3)
    x1 = rng.normal(size=400)
    x2 = x1 + 1e-4 * rng.normal(size=400)
    y = 1 + 2 * x1 + 3 * x2 + rng.normal(size=400)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x1, x2, y, 2 * x1)], "x1 double, x2 double, y double, x3 double")
    want = np.linalg.lstsq(np.stack([np.ones(400), x1, x2], axis=1), y, rcond=None)[0]
    got = {r.term: r.estimate for r in stats.ols(df, "y", ["x1", "x2", "x3"], residual_quantiles=False).coefficients.collect()}
    assert got["x3"] is None or math.isnan(got["x3"])
    assert [got["x1"], got["x2"]] == pytest.approx(want[1:].tolist(), rel=1e-4)


def test_folds_take_classes_in_order_of_appearance_and_null_labels(spark):
    labels = [1, 1, None, 0, 0, 1, None, 0, 1, 0, 1]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, y int")
    got = {r.id: r.fold for r in ml.stratified_folds(df, "id", "y", 3).collect()}
    assert sorted(got) == list(range(11)) and set(got.values()) == {0, 1, 2}
    # class 1 comes first (ids 0 1 5 8 10: sizes 2 2 1), then NULL, then 0
    assert [got[i] for i in (0, 1, 5, 8, 10)] == [0, 0, 1, 1, 2]


def test_confusion_has_all_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0), (1, 0)], "label int, prediction int")
    assert rows(ml.confusion(df)) == [(0, 1, 0, 1), (1, 2, 0, 0), (2, 0, 0, 0)]


def test_smote_raises_every_class(spark):
    rng = np.random.default_rng(1)
    data = [(f"id{i}", float(a), float(b), c) for i, ((a, b), c) in enumerate(zip(rng.normal(size=(17, 2)), [0] * 10 + [1] * 4 + [2] * 3))]
    df = spark.createDataFrame(data + [("none", 0.0, 0.0, None)], "id string, a double, b double, y int")
    out = ml.smote(df, "id", "y", ["a", "b"]).collect()
    count = {c: sum(r.y == c for r in out) for c in (0, 1, 2)}
    assert count == {0: 10, 1: 10, 2: 10} and sum(r.y is None for r in out) == 1
    assert len({(r.id, r.copy) for r in out}) == len(out)
    with pytest.raises(ValueError):
        ml.smote(df.where("y = 0 or id = 'id10'"), "id", "y", ["a", "b"])


def test_knn_impute_fills_nan_and_takes_text_ids(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 3)  # several blocks
    data = [("a", 1.0, 10.0), ("b", 1.1, None), ("c", float("nan"), 30.0), ("d", 3.0, 31.0), ("e", 0.9, 12.0), ("f", 9.0, 90.0), ("g", None, None)]
    df = spark.createDataFrame(data, "id string, x double, y double")
    got = {r.id: (r.x, r.y) for r in ml.knn_impute(df, "id", ["x", "y"], k=2).collect()}
    assert got["b"] == (1.1, 11.0) and got["c"] == (pytest.approx((3.0 + 0.9) / 2), 30.0)
    assert got["g"] == (pytest.approx(15.0 / 5), pytest.approx(173.0 / 5))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
