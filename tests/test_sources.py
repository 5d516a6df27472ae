"""Sources and sinks S1-S5 on small literal tables."""

import math

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import files as S


def test_read_csv_drops_pandas_index_column(spark):
    path = scratch_path(spark, "csv-index")
    spark.createDataFrame([(0, "a", 1.5), (1, "b", 2.5)], "_c0 int, name string, x double") \
        .write.option("header", True).csv(path)
    df = S.read_csv(spark, path, schema="idx int, name string, x double", index_col=0)
    assert df.columns == ["name", "x"]
    assert sorted((r.name, r.x) for r in df.collect()) == [("a", 1.5), ("b", 2.5)]


def test_library_save_partitioned_and_read_back(spark):
    lib = S.Library(spark, scratch_path(spark, "lib"))
    df = spark.createDataFrame([(2020, 1, 1.0), (2021, 2, 2.0)], "y int, m int, v double")
    back = lib.save(df, "monthly", partition_by=["y"])
    assert sorted((r.y, r.m, r.v) for r in back.collect()) == [(2020, 1, 1.0), (2021, 2, 2.0)]
    assert sorted(r.y for r in lib.table("monthly").where(F.col("y") == 2021).collect()) == [2021]


def test_from_matrix_literal_and_wide(spark):
    long = S.from_matrix(spark, [[1, 2], [3, 4]], "product", "segment", "cost", ["p1", "p2"], ["s1", "s2"])
    assert sorted(tuple(r) for r in long.collect()) == [("p1", "s1", 1), ("p1", "s2", 2), ("p2", "s1", 3), ("p2", "s2", 4)]
    wide = spark.createDataFrame([("p1", 1, 2)], "product string, s1 int, s2 int")
    assert sorted(tuple(r) for r in S.from_matrix(spark, wide, "product", "segment", "cost").collect()) == \
        [("p1", "s1", 1), ("p1", "s2", 2)]


def test_normalise_missing(spark):
    df = spark.createDataFrame([(1, float("nan"), "  "), (2, 2.0, "x"), (3, None, "")], "id int, v double, s string")
    out = {r.id: (r.v, r.s) for r in S.normalise_missing(df).collect()}
    assert out[1] == (None, None) and out[2] == (2.0, "x") and out[3] == (None, None)
    assert not any(isinstance(v, float) and math.isnan(v) for v, _ in out.values())


def test_a_table_that_cannot_be_read_is_not_taken_for_another(spark, tmp_path):
    import pytest

    from tessera.sources.files import Library

    lib = Library(spark, str(tmp_path))
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert lib.table("t").count() == 3          # no folder "t": the .parquet name
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt"):
        lib.table("t").count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lib.table("nowhere")


def test_rows_that_do_not_fit_go_to_a_side_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\nid,name,x\n1,a,1.5\n2,"b,c",2\n3,d\n4,e,5,6\n5,f,n/a\n,g,\nx,"h",1\n')
    (tmp_path / "b.csv").write_text("x,more,id\n7.5,q,10\n8.5,q\noops,q,oops\n")
    (tmp_path / "empty.csv").write_text("")
    good, bad = S.read_csv_checked(spark, str(tmp_path), "id int, name string, x double")
    assert sorted(good.collect(), key=str) == sorted([(1, "a", 1.5), (2, "b,c", 2.0), (None, "g", None), (10, None, 7.5)], key=str)
    assert sorted((r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect()) == [
        ("a.csv", "fields"), ("a.csv", "fields"), ("a.csv", "id"), ("a.csv", "x"), ("b.csv", "fields"), ("b.csv", "id")]
    assert {r.line for r in bad.where("reason = 'fields'").collect()} == {"3,d", "4,e,5,6", "8.5,q"}
    # the same rows fit, whatever is read of them
    assert good.select("name").count() == good.count() == 4 and bad.select("reason").count() == bad.count() == 6
    one, other = S.read_csv_checked(spark, str(tmp_path / "a.csv"), "id int, name string, x double", by_name=False)
    assert (one.count(), other.count()) == (3, 4)


def test_a_header_that_names_a_column_twice_is_refused(spark, tmp_path):
    import pytest

    (tmp_path / "a.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        S.read_csv_checked(spark, str(tmp_path), "id int")
    (tmp_path / "a.csv").write_text("")
    good, bad = S.read_csv_checked(spark, str(tmp_path), "id int")
    assert good.columns == ["id"] and good.count() == bad.count() == 0


def test_keyed_tables_join_without_an_exchange(spark, tmp_path):
    import pytest

    lib = S.Library(spark, str(tmp_path))
    # one key holds a third of the rows; keys may be missing
    rows = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, i) for i in range(3000)]
    facts = lib.save_keyed(spark.createDataFrame(rows, "k long, v long").repartition(6), "facts", ["k"], 8, parts=3)
    names = lib.save_keyed(spark.createDataFrame([(i, f"n{i}") for i in range(3000)], "key long, name string"), "names", ["key"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = facts.join(names, F.col("k") == F.col("key"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert j.count() == sum(k is not None for k, _ in rows)
        by = facts.groupBy("k").agg(F.sum("v").alias("s"))
        assert "Exchange" not in by._jdf.queryExecution().executedPlan().toString()
        want = {}
        for k, v in rows:
            want[k] = want.get(k, 0) + v
        assert {r.k: r.s for r in by.collect()} == want
        # a library opened again, as another session would
        spark.sql(f"drop table {lib._entry('names')}")
        again = S.Library(spark, str(tmp_path))
        back = again.attach_keyed("names", "key long, name string", ["key"], 8)
        plan = again.table("facts").join(back, F.col("k") == F.col("key"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and back.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # no task has written the whole of the hot key
    per_file = facts.where("k = 7").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 800
    with pytest.raises(Exception, match="(?i)exist"):
        lib.save_keyed(spark.range(3).withColumnRenamed("id", "k"), "facts", ["k"], 8)
    lib.save_keyed(spark.range(3).withColumnRenamed("id", "k"), "facts", ["k"], 4, mode="overwrite")
    assert lib.table("facts").count() == 3


def test_each_bucket_is_written_by_tasks_of_its_own(spark, tmp_path):
    lib = S.Library(spark, str(tmp_path))
    rows = [(None if i % 50 == 1 else i, i) for i in range(4000)]
    for parts in (1, 3):
        saved = lib.save_keyed(spark.createDataFrame(rows, "k long, v long").repartition(5), f"t{parts}", ["k"], 16, parts=parts)
        assert sorted(saved.collect(), key=str) == sorted(rows, key=str)
        files = [r.p.rsplit("/", 1)[1] for r in saved.select(F.col("_metadata.file_path").alias("p")).distinct().collect()]
        tasks = {}
        for f in files:   # part-<task>-<uuid>_<bucket>.c000...
            tasks.setdefault(f.split("-")[1], set()).add(f.split("_")[-1].split(".")[0])
        assert len(tasks) == 16 * parts and all(len(b) == 1 for b in tasks.values())


def test_buckets_follow_the_rows(spark, monkeypatch):
    from tessera.catalog import sources

    from .conftest import SF_SMALL

    assert S.bucket_count(spark.range(10), spark.range(0), least=8) == 8
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 100)
    assert S.bucket_count(spark.range(800), least=8) == 8 and S.bucket_count(spark.range(5), spark.range(801), least=8) == 16
    used, save = [], S.Library.save_keyed
    monkeypatch.setattr(S.Library, "save_keyed", lambda self, df, name, keys, buckets, **more: used.append((df.count(), buckets)) or save(self, df, name, keys, buckets, **more))
    out = sources.s3_library_keyed(spark, SF_SMALL)
    assert len({b for _, b in used}) == 1 and all(n <= 100 * b for n, b in used) and used[0][1] > 16
    items = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy("l_orderkey").count()
    assert sorted((r.o_orderkey, r["items"]) for r in out.collect()) == sorted((r[0], r[1]) for r in items.collect())
