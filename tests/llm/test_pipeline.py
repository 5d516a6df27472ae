"""The pipeline against a plain version of each stage on the same input."""

import collections

import pyarrow as pa
import pytest

import corpus_pipeline as P
from tessera.llm import mixing as M
from tessera.llm import quality_classifier as Q
from tessera.llm import quality_rules as R
from tessera.llm import words as W

from ..conftest import SF_SMALL
from . import data
from .test_mixing_sharding_packing import check_packed
from .test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of each stage."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    out = [docs]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).cache())
    return out


def test_stages_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "quality rules", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_filters_by_hand(spark, stages):
    docs, labels = P._tables(spark, SF_SMALL)
    forest = Q.learn(docs, labels)
    rows = stages[0].collect()
    scores = forest.score(Q.statistics(W.texts_of(pa.array([r.text for r in rows]))))
    assert collections.Counter(r for r, s in zip(rows, scores) if s >= 0.3) == collections.Counter(stages[1].collect())
    forest = R.learn(docs, labels)
    rows = stages[1].collect()
    counts, shares = R.measure(W.texts_of(pa.array([r.text for r in rows])))
    kept = ~R.base_failed(counts) & (forest.score(shares) >= 0.3)
    assert collections.Counter(r for r, k in zip(rows, kept) if k) == collections.Counter(stages[2].collect())


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = {c for _, c in brute(rows, 5, 80)}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(want)


def test_copies_follow_the_rates(spark, stages):
    labels = P._tables(spark, SF_SMALL)[1].where(~Q.held_out(P.F.col("doc_id")))
    domains = labels.select("doc_id", M.domain_of(P.F.col("quality"), P.F.col("toxic")).alias("domain"))
    mixed = M.mix(stages[3], domains, labelled=stages[0]).collect()
    want = collections.Counter({r.doc_id: r.copies for r in mixed if r.copies})
    assert collections.Counter(r.doc_id for r in stages[4].collect()) == want


def test_packing(spark, stages):
    n, bound = check_packed(stages[5].collect(), [(r.doc_id, r.text) for r in stages[4].collect()])
    assert n <= 1.05 * bound + 1


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF_SMALL).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(got) == sorted(stages[5].select("doc_id", "piece", "start", "length", "ids_crc32").collect())


def test_every_stage_takes_odd_and_empty_tables(spark):
    docs = data.table(spark).cache()
    empty = data.empty(spark)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() > 0, name
        assert stage(spark, empty, SF_SMALL).count() == 0, name
        docs = out.cache() if out.columns == docs.columns else docs
