"""Quantiles by selection: exact whatever the sketch says, and only the values
near the wanted positions are numbered."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregate as A
from tessera.operators import rank as R

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 rows: group 0 holds a third of them, a third of all rows share
    one value, one group is NULL, one has a single row, one only missing values."""
    v = F.when(F.col("id") % 3 == 1, F.lit(0.25)).otherwise(F.randn(7))
    g = (F.when(F.col("id") == 2, F.lit(100)).when(F.col("id").isin(5, 8, 11), F.lit(101))
         .when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5 + 1)).cast("int")
    v = F.when(F.col("id").isin(5, 8), F.lit(None)).when(F.col("id") == 11, F.lit(float("nan"))).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(v)
    df = spark.range(0, 60_000, 1, 8).select(g.alias("g"), v.cast("double").alias("v"))
    return df.checkpoint()


def _brute(df):
    rows = {}
    for r in df.collect():
        if r.v is not None and r.v == r.v:
            rows.setdefault(r.g, []).append(r.v)
    return {g: np.quantile(x, PROBS) for g, x in rows.items()}


@pytest.mark.parametrize("sketch, broadcast", [(2_000, 50_000), (20, 50_000), (2, 0)])
def test_grouped_quantiles_equal_numpy(spark, skewed, monkeypatch, sketch, broadcast):
    """Also with sketches so coarse that cells hold most values, and with
    bounds joined by a shuffle."""
    monkeypatch.setattr(R, "SKETCH", sketch)
    monkeypatch.setattr(R, "BROADCAST_GROUPS", broadcast)
    got = {r[0]: np.array(r[1:]) for r in R.quantiles(skewed, "v", PROBS, by=["g"]).collect()}
    want = _brute(skewed)
    assert set(got) == set(want) and 101 not in got and None in got
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-12), g


@pytest.mark.parametrize("rows_per_bucket", [2_000_000, 50])
def test_whole_column(spark, skewed, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(R, "ROWS_PER_BUCKET", rows_per_bucket)
    have = [r.v for r in skewed.collect() if r.v is not None and r.v == r.v]
    assert R.quantile_values(skewed, "v", PROBS) == pytest.approx(np.quantile(have, PROBS), rel=1e-12)


def test_group_columns_may_have_any_name(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 2, 5.0)], "p string, k int, v double")
    assert {tuple(r) for r in R.quantiles(df, "v", [0.5], by=["p", "k"]).collect()} == {("a", 1, 1.5), ("b", 2, 5.0)}


def test_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "g int, v double")
    assert R.quantile_values(df, "v", [0.5, 0.9]) == [None, None]
    assert R.quantile_values(df.limit(0), "v", [0.5]) == [None]
    assert R.quantiles(df, "v", [0.5], by=["g"]).count() == 0


def test_infinite_values_and_signed_zeros(spark):
    vals = [float("-inf"), -1.0, -0.0, 0.0, 0.0, 2.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert R.quantile_values(df, "v", [0.0, 1 / 6, 0.5, 5 / 6, 1.0]) == [float("-inf"), -1.0, 0.0, 2.0, float("inf")]


def test_few_values_are_numbered(spark):
    """200,000 distinct values, a third of them in one group: less than 2 %
    reach the numbering."""
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("g"),
                                              F.xxhash64("id").cast("double").alias("v"))
    candidates, targets, few = R.select_candidates(df, "v", [0.25, 0.5, 0.75], by=["g"])
    assert few and targets.count() == 10 * 3 * 2
    assert candidates.agg(F.sum("_w")).first()[0] < 0.02 * 200_000
    # every candidate's cell is one that a target names
    assert candidates.join(targets, ["g", "_cell"], "left_anti").count() == 0


def test_summary_and_box_go_by_selection(spark, skewed):
    s = A.summary(skewed, ["v"]).first()
    have = np.array([r.v for r in skewed.where(F.col("v").isNotNull() & ~F.isnan("v")).collect()])
    assert [s.q1, s.median, s.q3] == pytest.approx(np.quantile(have, [0.25, 0.5, 0.75]), rel=1e-12)
