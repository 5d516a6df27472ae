"""Plan properties of representative queries (checked with explain), and
source hygiene of the library."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E

from .conftest import SF_MID

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(spark, name):
    df = E.queries()[name](spark, SF_MID)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_reaches_the_scan(spark):
    p = plan(spark, "f1_filter_eq")
    assert "EqualTo(o_orderstatus,F)" in p


def test_projection_prunes_the_scan(spark):
    p = plan(spark, "p2_keep")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p


def test_restriction_is_a_semi_join(spark):
    assert "LeftSemi" in plan(spark, "j8_restrict_to")


def test_first_minus_last_needs_no_window_or_sort(spark):
    p = plan(spark, "a6_first_minus_last")
    assert "HashAggregate" in p and "Window" not in p and "Sort " not in p


def test_correlation_matrix_is_one_hash_aggregation(spark):
    p = plan(spark, "t2_corr_matrix")
    assert "HashAggregate" in p and "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_daily_consumption_has_no_full_outer_join_on_days(spark):
    p = plan(spark, "d1_daily_consumption")
    assert "FullOuter" not in p


@pytest.mark.parametrize("pattern", [r"\.crossJoin\(", r"localCheckpoint", r"\.rdd\b", r"F\.udf\(", r"@udf\b",
                                     r"how=\"cross\""])
def test_library_avoids(pattern):
    hits = []
    for root, _, files in os.walk(os.path.join(ROOT, "tessera")):
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(root, f)).read()
                code = "\n".join(line.split("#")[0] for line in src.splitlines())
                code = re.sub(r'"""[\s\S]*?"""', "", code)
                if re.search(pattern, code):
                    hits.append(f)
    assert hits == []


def test_python_worker_operators_run_from_any_directory(tmp_path):
    """A plain session started outside the repo (as the driver may) must still
    run the operators whose work happens in Python workers: the package is
    shipped to the workers with addPyFile."""
    import subprocess
    import sys

    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '4')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "q = E.queries()\n"
        "for n in ['t3_corr_test_p', 't7_ols_multi_by', 'm4_smote']:\n"
        "    print(n, q[n](spark, '/root/testdata/sf0.001').count())\n"
        "spark.stop()\n")
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "m4_smote" in out.stdout


def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys

    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="d1_daily_consumption,a16_histogram", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [x for x in out.stdout.strip().splitlines() if x.startswith("{")][-1]
    d = json.loads(line)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"d1_daily_consumption", "a16_histogram"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01)
