"""The segmented scan against Spark's plain windows, states against whole
runs, and the balance of its tasks."""

import datetime
import decimal
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ordered as O
from tessera.operators.scan import Fill, Lag, Scan, segmented

from .conftest import SF_MID


@pytest.fixture(scope="module")
def events(spark):
    """One entity has a third of the rows, all in one year of a year-first
    order; one is NULL; the order is partly text; ``flag`` has long gaps."""
    e = spark.read.parquet(f"{SF_MID}/events.parquet").select("user_id", "ts", "event_id", "event_type", "value")
    e = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).when(F.col("event_id") % 7 != 0, F.col("user_id")))
    e = e.dropDuplicates(["user_id", "ts"])
    e = e.withColumns({"y": F.lit(2020), "text_ts": F.date_format("ts", "yyyyMMddHHmmss.SSSSSS")})
    return e.withColumn("flag", F.when(F.col("event_type") == "purchase", "out").when(F.col("event_id") % 50 == 0, "in")).persist()


ORDER = ["y", "text_ts"]


@pytest.mark.parametrize("ranges", [None, 1, 13])
def test_equal_to_plain_windows(events, ranges):
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    whole = Window.orderBy("user_id", *ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    v = F.when(F.row_number().over(w) == 1, F.lit("in")).otherwise(F.col("flag"))
    want = events.withColumn("_v", v).withColumns({
        "l1": F.lag("value", 1).over(w), "l2": F.lag("value", 2).over(w), "l9": F.lag("flag", 9).over(w), "r1": F.lag("value", 1).over(whole),
        "r3": F.lag("ts", 3).over(whole), "f": F.last("flag", True).over(upto), "g": F.last("_v", True).over(upto)})
    want = want.withColumn("b", F.lag("g").over(w)).drop("_v")
    got = segmented(events, ["user_id"], ORDER,
                    [Lag("value", 1, "l1"), Lag("value", 2, "l2"), Lag("flag", 9, "l9"), Lag("value", 1, "r1", False), Lag("ts", 3, "r3", False)],
                    [Fill("flag", "f"), Fill("flag", "g", "in", "b")], ranges)
    cols = ["event_id", "user_id", "ts", "l1", "l2", "l9", "r1", "r3", "f", "g", "b"]
    key = lambda r: tuple(map(str, r))
    rows = sorted(map(tuple, got.select(cols).collect()), key=key)
    assert rows == sorted(map(tuple, want.select(cols).collect()), key=key)
    assert len(rows) == events.count() and any(r[1] is None for r in rows)


def test_a_hot_entity_is_spread_evenly(spark, events):
    """A third of the rows in one entity: no part above twice the median."""
    spread = segmented(events, ["user_id"], ORDER, [Lag("value", 1, "l1")], ranges=16)
    sizes = sorted(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * np.median(sizes)
    hot = spread.where("user_id = -1").groupBy(F.spark_partition_id()).count().count()
    assert hot >= 4


def test_no_window_is_left(spark, events, capsys):
    O.status_effective(events, "user_id", ORDER, "flag").explain()
    assert "Window" not in capsys.readouterr().out


def test_merged_states_equal_the_state_of_the_whole():
    rnd = random.Random(6)
    scan = Scan(["e"], [Lag("v", 3, "l")], [Fill("v", "f")])
    for _ in range(200):
        n = rnd.randint(2, 14)
        rows = sorted([(rnd.choice([None, 1, 2, 3]), i, rnd.choice([None, rnd.random()])) for i in range(n)], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        batch = pa.RecordBatch.from_pydict({"e": pa.array([r[0] for r in rows], pa.int64()), "v": pa.array([r[2] for r in rows], pa.float64())})
        cuts = sorted({0, n, *(rnd.randint(1, n) for _ in range(3))})
        parts = [scan.state(batch.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:])]
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.merge(p, scan.rows)
        right = parts[-1]   # and from the other side: merging is associative
        for p in parts[-2::-1]:
            right = p.merge(right, scan.rows)
        whole = scan.state(batch)
        for s in (merged, right):
            assert s.entity == whole.entity and s.open == whole.open
            for name in ("tails", "ends"):
                assert getattr(s, name)["v"].to_pylist() == getattr(whole, name)["v"].to_pylist()
            value = lambda x: x.rest["v"][0].as_py() if x.rest["v"].null_count == 0 else x.head["v"][0].as_py()
            assert value(s) == value(whole)


def test_types_are_kept_and_ties_are_stable(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(e, o, decimal.Decimal(f"{i}.25"), day + datetime.timedelta(i), [i, None], {"k": i}, bytes([i]), float("nan") if i % 3 else None)
            for i, (e, o) in enumerate([(a, b) for a in ("x", None, "y") for b in (2.0, None, float("nan"), 1.0, 1.0)])]
    df = spark.createDataFrame(rows, "e string, o double, d decimal(10,2), day date, xs array<int>, m map<string,int>, b binary, n double")
    cols = ["d", "day", "xs", "b", "m"]
    out = segmented(df.repartition(3), ["e"], ["o"], [Lag(c, 1, f"{c}1") for c in cols], [Fill("n", "filled", before="n_before")], ranges=4)
    assert [dict(out.dtypes)[f"{c}1"] for c in cols] == [dict(df.dtypes)[c] for c in cols]
    a = sorted(map(str, out.collect()))
    again = segmented(df.repartition(1), ["e"], ["o"], [Lag(c, 1, f"{c}1") for c in cols], [Fill("n", "filled", before="n_before")], ranges=2)
    assert sorted(map(str, again.collect())) == a
    first = {r.e: r for r in out.where("o is null").collect()}   # NULL sorts first
    assert len(first) == 3 and all(r.d1 is None for r in first.values())


def test_no_rows_clashing_names_and_descending_order(spark):
    df = spark.createDataFrame([], "e int, o int, v int")
    assert segmented(df, ["e"], ["o"], [Lag("v", 1, "l")]).collect() == []
    df = spark.createDataFrame([(1, 1, 10, 7), (1, 2, 20, 7), (1, 3, None, 7)], "e int, o int, v int, state int")
    out = segmented(df, ["e"], [F.col("o").desc()], [Lag("v", 1, "state")], [Fill("v", "f", 0)]).orderBy("o").collect()
    assert [(r.state, r.f) for r in out] == [(20, 10), (None, 20), (None, 0)]


@pytest.mark.parametrize("key", ["t", "d"])
def test_ranks_of_text_and_dates_with_a_hot_value_and_nulls(spark, key):
    from tessera.operators.rank import row_index

    df = spark.range(600).withColumns({
        "g": F.when(F.col("id") % 5 > 0, F.col("id") % 2), "t": F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.col("id"))),
        "d": F.when(F.col("id") % 3 == 0, F.lit("2024-01-01").cast("date")).when(F.col("id") % 7 > 0, F.date_add(F.lit("2023-12-01").cast("date"), F.col("id").cast("int")))})
    for by in ([], ["g"]):
        want = df.withColumn("i", F.row_number().over(Window.partitionBy(*by).orderBy(key, "id")) - 1)
        got = row_index(df.repartition(7), [key, "id"], by=by, out="i")
        assert sorted((r.id, r.i) for r in got.collect()) == sorted((r.id, r.i) for r in want.collect())
    assert row_index(df.limit(0), key, out="i").count() == 0


def test_folds_and_split_take_text_ids(spark):
    from tessera.operators import ml

    df = spark.createDataFrame([(f"id{i:03d}", i % 3 == 0) for i in range(90)], "id string, y boolean").repartition(4)
    f = {r.id: (r.y, r.fold) for r in ml.stratified_folds(df, "id", "y", 5).collect()}
    assert len(f) == 90 and {sum(v == (y, k) for v in f.values()) for y in (True,) for k in range(5)} == {6}
    for y in (True, False):   # contiguous blocks in id order
        folds = [f[i][1] for i in sorted(f) if f[i][0] == y]
        assert folds == sorted(folds)
    assert sum(r.is_test for r in ml.split(df, "id", 0.2, 42).collect()) == 18
