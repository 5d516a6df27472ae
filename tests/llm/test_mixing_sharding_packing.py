import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from tessera.llm import mixing as M
from tessera.llm import packing as K
from tessera.llm import sharding as S
from tessera.llm.queries import END_ID, TOKENIZER

from ..conftest import SF_MID, SF_SMALL
from . import data

PATH = public_tokenizers.path(TOKENIZER)


def mixture(spark, n=600):
    rng = np.random.default_rng(5)
    words = {"clean": [f"c{i}" for i in range(200)], "toxic": [f"c{i}" for i in range(200)] + ["vile"] * 60, "low": [f"l{i}" for i in range(50)]}
    rows, domains = [], []
    for i in range(n):
        d = ["clean", "clean", "clean", "toxic", "low"][i % 5]
        rows.append((i, " ".join(rng.choice(words[d], rng.integers(30, 120))), "en", "s", i))
        if i % 2:
            domains.append((i, d))
    return rows, spark.createDataFrame(domains, "doc_id long, domain string")


def test_expected_totals_match_the_targets(spark):
    rows, domains = mixture(spark)
    shares = {"clean": 0.8, "toxic": 0.05, "low": 0.15}
    out = M.mix(data.table(spark, rows), domains, shares).collect()
    p, t, r = np.array([x.posterior for x in out]), np.array([x.tokens for x in out]), np.array([x.rate for x in out])
    got = (p * (t * r)[:, None]).sum(0)
    assert (r >= 0).all() and np.allclose(got / got.sum(), [0.8, 0.05, 0.15], atol=2e-3)
    assert got.sum() == pytest.approx((p * t[:, None]).sum(0)[0] / 0.8, rel=2e-3)
    assert t.tolist() == [len(x.text.split()) for x in out]
    held = [x for x in out if x.doc_id % 2 == 0]  # not learned from
    right = [["clean", "toxic", "low"][int(np.argmax(x.posterior))] == ["clean", "clean", "clean", "toxic", "low"][x.doc_id % 5] for x in held]
    assert np.mean(right) > 0.9
    assert all(x.copies in (int(x.rate), int(x.rate) + 1) for x in out)
    assert sum(x.copies for x in out) == pytest.approx(r.sum(), rel=0.1)
    big = M.mix(data.table(spark, rows), domains, shares, total=3 * got.sum()).agg(F.sum("copies")).first()[0]
    assert big == pytest.approx(3 * r.sum(), rel=0.1)
    expanded = M.expand(M.mix(data.table(spark, rows), domains, shares), ["doc_id", "text"]).groupBy("doc_id").count().collect()
    assert {x.doc_id: x["count"] for x in expanded} == {x.doc_id: x.copies for x in out if x.copies}


def test_mixing_odd_rows(spark):
    rows = data.documents()
    docs = data.table(spark, rows).withColumn("rate", F.lit("old"))
    domains = spark.createDataFrame([(r[0], "low" if r[1] and "#" in r[1] else "clean") for r in rows if r[0] is not None and r[0] < 1000], "doc_id long, domain string")
    out = M.mix(docs, domains).collect()
    assert len(out) == len(rows)
    assert [(x.tokens, x.rate, x.copies) for x in out if x.doc_id == 5000] == [(0, 1.0, 1)]
    assert len({(x.rate, x.copies) for x in out if x.doc_id == rows[3][0]}) == 1
    nothing = domains.limit(0)
    assert {(x.rate, x.copies) for x in M.mix(docs, nothing).collect()} == {(1.0, 1)}
    assert M.mix(data.empty(spark), nothing).count() == 0


def test_op6_covers_all_documents(spark):
    out = E.queries()["op6_soft_mixing"](spark, SF_MID)
    assert out.count() == 1000 and out.where("rate < 0 or copies < 0").count() == 0


def check_shards(rows, shards):
    n = collections.Counter(r.shard for r in rows)
    assert max(n.values()) - min(n.get(s, 0) for s in range(shards)) <= 1
    for s in n:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))


@pytest.mark.parametrize("bucket_rows", [2_000, 40])
def test_shards_match_the_mixture(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(S, "BUCKET_ROWS", bucket_rows)
    rows = [(i, f"text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 40}" if i % 2 else None, 1) for i in range(1200)]
    out = S.interleave(data.table(spark, rows), 8).collect()
    assert sorted(r.doc_id for r in out) == list(range(1200))
    check_shards(out, 8)
    total = collections.Counter(r.source for r in out)
    for shard in range(8):
        part = collections.Counter(r.source for r in out if r.shard == shard)
        assert all(abs(part[s] - total[s] / 8) < 2 for s in total)
    again = S.interleave(data.table(spark, rows, 7), 8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in out}
    other = S.interleave(data.table(spark, rows), 8, seed=1).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in other} != {(r.doc_id, r.shard, r.slot) for r in out}


def test_shards_of_odd_rows(spark):
    rows = data.documents()
    docs = data.table(spark, rows).withColumn("slot", F.lit("old"))
    out = S.interleave(docs, 5)
    assert sorted(out.columns) == sorted([*docs.columns, "shard"])
    out = out.collect()
    check_shards(out, 5)
    assert collections.Counter((r.doc_id, r.text) for r in out) == collections.Counter(r[:2] for r in rows)
    assert S.interleave(data.empty(spark), 8).count() == 0
    check_shards(S.interleave(data.table(spark, rows[:3], 1), 8).collect(), 3)


def test_texts_are_shuffled_once(spark):
    """The join of rows and places and the numbering of copies share one exchange."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = S.interleave(data.table(spark, data.documents()), 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(_key#") == 1


def test_op7_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    out = E.queries()["op7_interleaved_shards"](spark, SF_MID).collect()
    check_shards(out, 8)
    assert {(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in out} == {
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows", None) for i, t in docs.items()}


def test_plan_uses_the_histogram_exactly():
    rng = np.random.default_rng(0)
    for lengths in (rng.lognormal(6, 1, 3000).astype(int).clip(1, 4096), np.full(100, 1500), rng.integers(2100, 4097, 300), np.array([4096]), np.zeros(0, int)):
        hist = np.bincount(lengths, minlength=4097)
        used, sequences = np.zeros(4097, int), 0
        for pattern, times in K.plan(hist):
            assert sum(pattern) <= 4096 and times > 0
            sequences += times
            np.add.at(used, list(pattern), times)
        assert (used == hist).all()
        if len(lengths) == 3000:
            assert sequences <= 1.01 * -(-lengths.sum() // 4096) + 1


def test_nnls_against_normal_conditions():
    patterns = [(3, 2), (3, 1), (2, 2), (1, 1, 1)]
    hist = np.array([0, 9, 10, 7, 0], float)
    c = K.nnls(patterns, hist, 3000)
    a = np.zeros((5, 4))
    for j, p in enumerate(patterns):
        np.add.at(a[:, j], list(p), 1)
    slope = a.T @ (a @ c - hist)
    assert (c >= 0).all() and (slope > -1e-3).all() and (np.abs(slope[c > 1e-6]) < 1e-3).all()


def check_packed(rows, texts, capacity=4096):
    tok = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [END_ID]
        for p in range(0, len(ids), capacity):
            part = ids[p:p + capacity]
            want[i, p // capacity, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(sequences), -(-total // capacity)


def test_op10_query_and_pieces(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n, bound = check_packed(E.queries()["op10_pack_sequences"](spark, SF_SMALL).collect(), texts)
    assert n <= 1.02 * bound + 1


def test_packing_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "RANK_ROWS", 2)
    rows = data.documents()
    docs = data.table(spark, rows).withColumnRenamed("n_chars", "offset")
    check_packed(K.pack_documents(docs, PATH, END_ID).collect(), [r[:2] for r in rows])
    assert K.pack_documents(data.empty(spark), PATH, END_ID).count() == 0


def test_sequences_hold_the_ids_of_their_pieces(spark):
    docs = data.table(spark, [r for r in data.documents() if r[0] is not None and r[0] < 100])
    pieces = K.tokenise_pieces(docs, PATH, END_ID, 256, with_ids=True)
    packed = K.pack(pieces, 256).collect()
    whole = {r.sequence_id: bytes(r.ids) for r in K.sequences(K.pack(pieces, 256)).collect()}
    ids = collections.Counter(b for r in packed for b in [bytes(r.ids)])
    back = collections.Counter(whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] for r in packed)
    assert len(whole) == len({r.sequence_id for r in packed}) and ids == back
