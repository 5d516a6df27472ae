import collections
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import boosting
from tessera.llm import quality_classifier as Q
from tessera.llm import quality_rules as R
from tessera.llm import words as W

from ..conftest import SF_MID, SF_SMALL
from . import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    times = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if times[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def labels(spark, rows):
    return spark.createDataFrame([(r[0], 0 if r[1] and "#" in r[1] else 1, 0) for r in rows if r[0] is not None and r[0] % 2 == 0],
                                 "doc_id long, quality int, toxic int")


def test_trees_fit_and_flatten():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    # a walk of single rows gives the same
    for row in x[2000:2010]:
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        assert abs(total - forest.raw(row[None])[0]) < 1e-9


def test_monotone_features_never_act_against_their_sign():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = (np.sin(6 * x[:, 0]) + x[:, 1] - x[:, 2] + rng.normal(0, 0.5, 2000) > 0).astype(float)
    forest = boosting.fit(x, y, (1, 1, -1))
    grid = np.linspace(0, 1, 50)
    for j, sign in enumerate((1, 1, -1)):
        for row in x[:40]:
            rows = np.repeat(row[None], 50, axis=0)
            rows[:, j] = grid
            assert (np.diff(forest.raw(rows)) * sign >= -1e-9).all()


def test_no_rows_or_one_class_do_not_fail():
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (boosting.fit(np.ones((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.8).all()


def test_op1_scores_all_rows_and_learns_from_the_rest_only(spark):
    rows = E.queries()["op1_quality_classifier"](spark, SF_MID).collect()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.95


def test_the_sample_is_bounded_and_without_held_out_rows(spark):
    docs, labelled = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = Q.labelled_sample(docs, labelled, rows=50).collect()
    assert len(got) == 50 and not any(zlib.crc32(str(r["_id"]).encode()) % 5 == 0 for r in got)


def test_op1_odd_rows(spark):
    rows = data.documents()
    docs = data.table(spark, rows).withColumn("score", F.lit("old")).withColumn("extra", F.array(F.lit(1)))
    forest = Q.learn(docs, labels(spark, rows))
    out = Q.score(docs, forest).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {*docs.columns, "predicted"}
    score = {r.doc_id: r.score for r in out}
    assert 0 <= score[5000] <= 1 and score[5000] == score[5001]
    assert collections.Counter(r.doc_id for r in out)[rows[3][0]] == 4
    assert Q.score(data.empty(spark), forest).count() == 0
    none = Q.learn(docs, labels(spark, []))
    assert {r.score for r in Q.score(docs, none, keep=["doc_id"]).collect()} == {0.5}


def test_op2_equals_brute_force(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = E.queries()["op2_quality_rules"](spark, SF_SMALL).collect()
    assert len(rows) == len(text)
    for r in rows:
        n, chars, symbols, dup, repeat = brute_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert r.kept == (not r.base_failed and r.score >= 0.3)


def test_op2_odd_rows(spark):
    rows = data.documents()
    docs = data.table(spark, rows).withColumn("kept", F.lit(None).cast("string"))
    forest = R.learn(docs, labels(spark, rows))
    out = R.judge(docs, forest).collect()
    assert len(out) == len(rows)
    want = {r[0]: brute_counts(r[1]) for r in rows if r[0] is not None}
    for r in out:
        if r.doc_id is not None:
            assert tuple(r[c] for c in R.COUNTS) == want[r.doc_id]
    assert [r.kept for r in out if r.doc_id == 5000] == [False]
    assert R.judge(data.empty(spark), forest).count() == 0


def test_counts_of_lines_windows_and_symbols():
    texts = ["a b c a b c", "x\nx\n \n \ny\nx", "a a a a", "", "#|| <a>\r\nb", "ä€😀 é"]
    counts, _ = R.measure(W.texts_of(pa.array(texts)))
    assert [tuple(c) for c in counts] == [brute_counts(t) for t in texts]
