"""Missing-value and ordering rules and the
defect choices of section 1.5, on tiny literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as C
from tessera.operators import aggregate as A
from tessera.operators import frame as Fr
from tessera.operators import joins as J
from tessera.operators import ordered as O
from tessera.plans import equity, fuel


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def test_n1_missing_counts_as_smallest(spark):
    df = spark.createDataFrame([(1, 5e7), (2, None), (3, 1e6)], "id int, se double")
    assert [r.id for r in Fr.drop_at_or_below(df, "se", 1e7).collect()] == [1]


def test_n2_threshold_dummy_missing_is_zero_and_r_keeps_na(spark):
    df = spark.createDataFrame([(1, 0.2), (2, None), (3, 0.05)], "id int, x double")
    out = df.select("id", C.dummy(F.col("x") >= 0.1, 0).alias("sas"), C.dummy(F.col("x") >= 0.1, None).alias("r"))
    assert rows(out, "id", "sas", "r") == [(1, 1, 1), (2, 0, None), (3, 0, 0)]


def test_n3_clamp_maps_nan_negative_and_missing_to_zero(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, -3.0), (3, None), (4, 2.5)], "id int, x double")
    assert rows(df.select("id", C.clamp0("x").alias("y")), "id", "y") == [(1, 0.0), (2, 0.0), (3, 0.0), (4, 2.5)]


def test_n4_pandas_sum_drops_null_keys_and_all_null_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 3.0), ("b", 1.0)], "k string, v double")
    assert rows(A.sum_by(df, ["k"], ["v"], "pandas"), "k", "v") == [("a", 0.0), ("b", 1.0)]


def test_n5_sql_sum_keeps_null_class(spark):
    df = spark.createDataFrame([("a", None), (None, 3.0)], "k string, v double")
    out = A.sum_by(df, ["k"], ["v"], "sql").collect()
    assert {(r.k, r.v) for r in out} == {("a", None), (None, 3.0)}


def test_n6_n8_filter_before_lag_and_n7_after(spark):
    df = spark.createDataFrame([(1, 1, 10.0, 1), (1, 2, 20.0, 0), (1, 3, 30.0, 1)], "e int, t int, v double, keep int")
    before = O.lag_by(df, "e", "t", "v", where=F.col("keep") == 1, when="before")
    after = O.lag_by(df, "e", "t", "v", where=F.col("keep") == 1, when="after")
    assert rows(before, "t", "v_lag1") == [(1, None), (3, 10.0)]
    assert rows(after, "t", "v_lag1") == [(1, None), (3, 20.0)]


def test_n9_lag_without_reset_leaks_previous_entity(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 5.0), (2, 2, 6.0)], "e int, t int, v double")
    out = O.lag_by(df, "e", "t", "v", reset=False)
    assert rows(out, "e", "t", "v_lag1") == [(1, 1, None), (1, 2, 1.0), (2, 1, 2.0), (2, 2, 5.0)]


def test_n10_lag_of_reset_lag_is_lag2(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(1, 5)], "e int, t int, v double")
    l1 = O.lag_by(df, "e", "t", "v", out="l1")
    l2 = O.lag_by(l1, "e", "t", "l1", out="l_of_l")
    two = O.lag_by(df, "e", "t", "v", n=2, out="l2")
    assert rows(l2, "t", "l_of_l") == rows(two.withColumnRenamed("l2", "l_of_l"), "t", "l_of_l")


def test_n11_n12_n13_status_fill_and_decision(spark):
    df = spark.createDataFrame([(1, 1, "out"), (1, 2, None), (1, 3, "in"), (1, 4, None)], "e int, t int, s string")
    forced = O.status_effective(df, "e", "t", "s", default="in")
    assert rows(forced, "t", "s_filled", "decision") == [(1, "in", "in"), (2, "in", "in"), (3, "in", "in"), (4, "in", "in")]
    df2 = spark.createDataFrame([(1, 1, None), (1, 2, "out"), (1, 3, None)], "e int, t int, s string")
    eff = O.status_effective(df2, "e", "t", "s", default="in")
    assert rows(eff, "t", "s_filled", "decision") == [(1, "in", "in"), (2, "out", "in"), (3, "out", "out")]
    plain = O.ffill(df2, "e", "t", "s")
    assert rows(plain, "t", "s_filled") == [(1, None), (2, "out"), (3, "out")]


def test_n15_population_vs_sample_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    pop = A.score_summary(df, "x").first()["std_pop"]
    samp = A.std_by(df.withColumn("k", F.lit(1)), ["k"], "x").first()["std_x"]
    assert pop == pytest.approx(1.118033988749895)
    assert samp == pytest.approx(1.2909944487358056)


def test_n16_first_and_last_follow_timestamp_not_day(spark):
    ts = [dt.datetime(2024, 1, 1, h) for h in (9, 17, 12)]
    df = spark.createDataFrame([(1, t, v) for t, v in zip(ts, [100.0, 40.0, 70.0])], "tank int, ts timestamp, lvl double")
    out = A.first_minus_last(df.withColumn("day", F.to_date("ts")), ["tank", "day"], "lvl", "ts").first()
    assert out["delta"] == 60.0


def test_n17_day_numbers_by_calendar_and_by_appearance(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), 1), (dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 3), 3)],
                               "day date, pos int")
    cal = O.period_number(df, "day")
    app = O.period_number(df, "day", by="appearance", position="pos")
    assert rows(cal, "pos", "date_number") == [(1, 2), (2, 1), (3, 2)]
    assert rows(app, "pos", "date_number") == [(1, 1), (2, 2), (3, 1)]


def test_rounding_half_even_and_bands_right_closed(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (15000.0,), (15000.01,), (None,)], "x double")
    out = df.select("x", C.round_even("x").alias("r"), C.band("x", [15000, 25000, 40000]).alias("b")).collect()
    got = {r.x: (r.r, r.b) for r in out}
    assert got[2.5] == (2.0, 1) and got[3.5] == (4.0, 1)
    assert got[15000.0][1] == 1 and got[15000.01][1] == 2
    assert got[None] == (None, None)


def test_temperature_known_answers(spark):
    df = spark.createDataFrame([(1, "25", "C"), (2, "85", "F"), (3, "C", "F"), (4, "25", "aaaa"), (5, "x", "y")],
                               "id int, v string, u string")
    out = {r.id: r for r in C.convert_temperature(df, "v", "u").collect()}
    assert round(out[1].converted, 1) == 77.0 and out[1].to_unit == "F"
    assert round(out[2].converted, 1) == 29.4 and out[2].to_unit == "C"
    assert out[3].reason == "bad value" and out[4].reason == "bad unit" and out[5].reason == "bad value and unit"


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([("J66",), (None,), ("C01",)], "c string")
    assert sorted([r.c or "" for r in Fr.filter_not_in(df, "c", ["J66"]).collect()]) == ["", "C01"]


def test_delete_if_keeps_unknown(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "id int, m int")
    assert [r.id for r in Fr.delete_if(df, F.col("m") == 1).orderBy("id").collect()] == [2, 3]


def test_join_validated_raises_on_duplicate_right_keys(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(J.CardinalityError):
        J.join_validated(a, b, ["k"], "left", "many_to_one")


def test_first_per_key_both_directions(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 7, 2), (1, 7, 3), (2, 1, 4)], "k int, v int, id int")
    desc = Fr.first_per_key(df, ["k"], [("v", False), ("id", False)])
    mixed = Fr.first_per_key(df, ["k"], [("v", False), ("id", True)])
    assert rows(desc, "k", "id") == [(1, 3), (2, 4)]
    assert rows(mixed, "k", "id") == [(1, 2), (2, 4)]


def test_histogram_half_open_with_top_edge_folded(spark):
    df = spark.createDataFrame([(0.0,), (1 / 6,), (0.5,), (1.0,), (1.2,)], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 6, 0.0, 1.0).collect()}
    assert h == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1}


def test_quantile_groups_rank_method_average_ties(spark):
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([1, 2, 2, 3, 4])], "p int, id int, x double")
    g = O.quantile_groups(df, "p", "x", 2, "rank")
    # avg ranks 1, 2.5, 2.5, 4, 5; floor(r*2/6)+1
    assert rows(g, "id", "grp") == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2)]


def test_ratio_growth_default_divides_by_later_value(spark):
    df = spark.createDataFrame([(1, y, 12, 2e7 * (y - 2000), 1e7) for y in (2001, 2002, 2003)],
                               "entity int, y int, m int, spend double, cap double")
    g = equity.ratio_growth(df, floor=1e6).first()
    assert g["g"] == pytest.approx((4.0 - 2.0) / 4.0)


def test_daily_consumption_day_without_site_rows(spark):
    readings = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1, 8), 100.0), (1, dt.datetime(2024, 1, 1, 20), 60.0),
        (9, dt.datetime(2024, 1, 2, 8), 50.0)], "tank_id long, ts timestamp, fuel_level double")
    tanks = spark.createDataFrame([(1, 3, "U")], "tank_id long, location int, tank_type string")
    purchases = spark.createDataFrame([(1, dt.date(2024, 1, 1), 3, "G", 15.0, 1.0)],
                                      "invoice_id long, invoice_date date, location int, fuel_type string, amount double, cost double")
    sites = spark.createDataFrame([(3, "North")], "location int, site_name string")
    out = fuel.daily_consumption(readings, tanks, purchases, sites).orderBy("date_number").collect()
    assert len(out) == 2
    assert out[0]["gas_total"] == 55.0 and out[0]["site_name"] == "North" and out[0]["diesel_total"] == 0.0
    assert out[1]["location"] is None and out[1]["date_number"] == 2


def _fuel_inputs(spark):
    readings = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1, 8), 100.0), (1, dt.datetime(2024, 1, 1, 20), 60.0),
        (2, dt.datetime(2024, 1, 1, 9), 80.0), (2, dt.datetime(2024, 1, 1, 21), 50.0)],
        "tank_id long, ts timestamp, fuel_level double")
    tanks = spark.createDataFrame([(1, 3, "U"), (2, 4, "D")], "tank_id long, location int, tank_type string")
    purchases = spark.createDataFrame([], "invoice_id long, invoice_date date, location int, fuel_type string, "
                                          "amount double, cost double")
    sites = spark.createDataFrame([(3, "North"), (4, "South")], "location int, site_name string")
    return readings, tanks, purchases, sites


def test_daily_consumption_left_vs_outer_for_diesel_only_sites(spark):
    left = fuel.daily_consumption(*_fuel_inputs(spark)).collect()
    outer = fuel.daily_consumption(*_fuel_inputs(spark), how="outer").collect()
    assert [r.location for r in left] == [3]              # as written: gas side left-joins diesel
    got = {r.location: r for r in outer}
    assert set(got) == {3, 4}
    assert got[4].diesel_total == 30.0 and got[4].gas_consumption is None and got[4].gas_total == 0.0


def test_single_sort_explicit_status_filter(spark):
    df = spark.createDataFrame([(1, 2001, 1, 0.1, 10.0, "1", "in"), (2, 2001, 1, 0.3, 30.0, "1", "out")],
                               "entity int, y int, m int, ret double, mvlag double, grp string, decision string")
    all_rows = equity.single_sort(df, "grp", 200101, 200112).first()
    kept = equity.single_sort(df, "grp", 200101, 200112, where=F.col("decision") == "in").first()
    assert all_rows["n"] == 2 and kept["n"] == 1 and kept["ew"] == pytest.approx(0.1)


def test_ratio_growth_older_base(spark):
    df = spark.createDataFrame([(1, y, 12, 2e7 * (y - 2000), 1e7) for y in (2001, 2002, 2003)],
                               "entity int, y int, m int, spend double, cap double")
    assert equity.ratio_growth(df, floor=1e6, base="older").first()["g"] == pytest.approx((4.0 - 2.0) / 2.0)


def test_check_plan_box_size_limits_and_segments(spark):
    from tessera.plans import bundle

    x = spark.createDataFrame([(i, 1) for i in range(3)] + [(i, 2) for i in range(3, 8)], "product int, box int")
    y = spark.createDataFrame([("A", 1), ("A", 2), ("B", 2)], "segment string, box int")
    seg = spark.createDataFrame([("A", 50000), ("B", 40000), ("C", 1)], "segment string, n long")
    r = {(row.rule, row.key): (row.value, row.ok) for row in bundle.check_plan(x, y, seg).collect()}
    assert r[("box_size", "1")] == (3, False) and r[("box_size", "2")] == (5, True)     # limits 4..7
    assert r[("segment_boxes", "A")] == (2, False) and r[("segment_boxes", "C")] == (0, False)
    assert r[("product_cap", "3")] == (90000, False)      # 50 000 + 40 000 > 80 000


def test_knn_impute_writes_back_by_key(spark):
    from tessera.operators import ml

    df = spark.createDataFrame([(10, 1.0, 1.0), (20, 1.1, None), (30, 5.0, 5.0), (40, 1.2, 2.0)],
                               "id long, a double, b double")
    out = {r.id: r for r in ml.knn_impute(df.repartition(3), "id", ["a", "b"], k=2).collect()}
    assert out[20].b == pytest.approx((1.0 + 2.0) / 2)    # two nearest by a: ids 10 and 40
    assert out[30].b == 5.0 and out[10].a == 1.0           # observed cells untouched, rows keep their ids


def test_pca_fitted_on_training_rows_only(spark):
    from tessera.operators import ml

    train = [(i, float(i), float(2 * i), 0) for i in range(20)]
    test = [(100, 1000.0, -1000.0, 1)]
    df = spark.createDataFrame(train + test, "id long, a double, b double, is_test int")
    fit_train = ml.pca(df, ["a", "b"], 1, fit_on=df.where("is_test = 0")).where("is_test = 0")
    only_train = ml.pca(df.where("is_test = 0"), ["a", "b"], 1)
    a = sorted((r.id, round(r.PCA_1, 9)) for r in fit_train.collect())
    b = sorted((r.id, round(r.PCA_1, 9)) for r in only_train.collect())
    assert a == b                                          # the test row did not move the components


def test_factor_alphas_dispatch(spark):
    port = spark.createDataFrame([("1", 2001, m, 0.01 * m, 0.02 * m) for m in range(1, 13)],
                                 "grp string, y int, m int, ew double, vw double")
    fac = spark.createDataFrame([(2001, m, 0.003 * m, 0.001, 0.002 * m, 0.0005) for m in range(1, 13)],
                                "y int, m int, mkt double, smb double, hml double, rf double")
    raw = equity.factor_alphas(port, fac, "ew", "raw").first()
    assert raw["mean"] == pytest.approx(0.065) and raw["n"] == 12
    capm = equity.factor_alphas(port, fac, "vw", "capm").first()
    assert capm["n"] == 12 and capm["beta"] is not None
    with pytest.raises(ValueError):
        equity.factor_alphas(port, fac, "ew", "nope")


def test_complete_entities_counts_periods_as_bits(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tessera.operators import reshape as R

    # 150 days (three words of bits), some before 1970; entity 0 holds a third of the rows, with repeats
    days = [dt.date(1969, 11, 20) + dt.timedelta(days=i) for i in range(150)]
    rows = [(0, d, 1.0) for d in days for _ in range(4)] + [(1, d, 1.0) for d in days] + [(2, d, 1.0) for d in days[1:]]
    rows += [(3, d, None if d == days[70] else float("nan") if d == days[71] else 1.0) for d in days] + [(None, d, 1.0) for d in days] + [(4, None, 1.0)]
    df = spark.createDataFrame(rows, "e int, d date, v double")

    def kept(*a, **k):
        return {r[0] for r in R.complete_entities(*a, **k).select("e").distinct().collect()}

    assert kept(df, ["e"], "d") == {0, 1, 3, None}
    assert kept(df, ["e"], "d", measure="v") == {0, 1, None}
    assert kept(df, ["e"], "d", n_periods=149) == {2}
    by_number = df.withColumn("p", F.datediff("d", F.lit(dt.date(1970, 1, 1))).cast("bigint"))
    assert kept(by_number, ["e"], "p") == kept(df.withColumn("p", F.col("d").cast("string")), ["e"], "p") == {0, 1, 3, None}
    assert kept(df.where("false"), ["e"], "d") == set() and kept(df.where("d is null"), ["e"], "d") == {4}
    plan = R.complete_entities(df, ["e"], "d")._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "Expand" not in plan and "distinct" not in plan


def test_alphas_over_a_window_of_months(spark):
    from tessera.plans import equity as Q

    months = [(y, m) for y in (2000, 2001) for m in range(1, 13)]
    port = spark.createDataFrame([(g, y, m, 0.01 * ((y + m * k) % 7) + 0.002 * k, None) for k, g in enumerate(["1", "H-L"], 1) for y, m in months],
                                 "grp string, y int, m int, ew double, vw double")
    fac = spark.createDataFrame([(y, m, 0.01 * ((3 * m + y) % 5), 0.003 * (m % 4), 0.002 * (m % 3), 0.001) for y, m in months],
                                "y int, m int, mkt double, smb double, hml double, rf double")
    for model in ("raw", "capm", "ff3"):
        part = port.where("y * 100 + m between 200003 and 200110")
        keys = ["grp", "term"] if model == "ff3" else ["grp"]
        got = Q.factor_alphas(port, fac, "ew", model, window=(200003, 200110)).toPandas().sort_values(keys)
        want = Q.factor_alphas(part, fac, "ew", model).toPandas().sort_values(keys)
        assert got[keys].values.tolist() == want[keys].values.tolist() and set(got["n"]) == {20}
        rest = [c for c in want if c not in keys]
        assert abs(got[rest].to_numpy(float) - want[rest].to_numpy(float)).max() < 1e-9
    assert {r.n for r in Q.raw_returns(port, "ew", (200003, None)).collect()} == {22}
    assert {r.n for r in Q.raw_returns(port, "ew", (None, 200002)).collect()} == {2}
    assert {r.n for r in Q.raw_returns(port, "ew").collect()} == {24}
