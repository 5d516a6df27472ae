import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from tessera.llm import token_store as S
from tessera.llm.queries import END_ID, TOKENIZER

from ..conftest import SF_SMALL
from . import data

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64)
    h = S.key_hashes(keys, np.zeros(n, bool))
    mph = S.PerfectHash.build(h)
    assert sorted(mph.values(h).tolist()) == list(range(n))


def test_query_is_what_the_tokenizer_gives(spark, tok):
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in E.queries()["op4_token_shards"](spark, SF_SMALL).collect()}
    assert len(rows) == len(docs)
    start = 0
    for d in docs:
        ids = tok(d.text)
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_odd_rows_small_shards_and_lookup(spark, tok):
    rows = data.documents()
    docs = data.table(spark, rows).withColumnRenamed("n_chars", "key")  # a clashing name
    manifest = S.write_shards(docs, PATH, END_ID, shard_bytes=20_000)
    assert manifest.count() > 3
    got = S.read_shards(manifest).orderBy("start").collect()
    assert len(got) == len(rows)
    order = [(-1 if r.key is None else r.key) for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    want = collections.Counter((r[0], crc(tok(r[1]))) for r in rows)
    assert collections.Counter((r.key, r.ids_crc32) for r in got) == want
    ask = spark.createDataFrame([(0,), (5003,), (rows[3][0],), (None,), (777_777,), (-5,)], "key long")
    found = collections.Counter((r.key, tuple(r.ids)) for r in S.lookup(manifest, ask).collect())
    assert found == collections.Counter((r[0], tuple(tok(r[1]))) for r in rows if r[0] in (0, 5003, rows[3][0], None))


def test_empty_table(spark):
    manifest = S.write_shards(data.empty(spark), PATH, END_ID)
    assert manifest.count() == 0 and S.read_shards(manifest).count() == 0


def test_a_shard_rejects_other_keys_by_fingerprint(spark):
    docs = spark.createDataFrame([(i * 3, f"text {i}") for i in range(500)], "doc_id long, text string")
    manifest = S.write_shards(docs, PATH, END_ID)
    shard = S.Shard(manifest.first()["file"])
    there = np.arange(0, 1500, 3)
    assert (shard.find(there, np.zeros(500, bool)) == np.arange(500)).all()
    absent = np.setdiff1d(np.arange(-1000, 3000), there)
    assert (shard.find(absent, np.zeros(len(absent), bool)) == -1).all()
    shard.close()


def test_rows_are_read_back_by_the_ordinals_of_the_index(spark, tok, monkeypatch):
    rows = [(None, "null"), (7, "a b c"), (7, "d"), (7, "e f"), (9, ""), (12, None), (12, "long " * 50)]
    shard = S.Shard(S.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), PATH, END_ID).first()["file"])
    ordinals, which = shard.documents(np.array([12, 0, 7]), np.array([False, True, False]))
    assert ordinals.tolist() == [5, 6, 0, 1, 2, 3] and which.tolist() == [0, 0, 1, 2, 2, 2]
    with pytest.raises(KeyError):
        shard.documents(np.array([8]), np.array([False]))
    asked, find = [], shard.find
    monkeypatch.setattr(shard, "find", lambda k, null: asked.extend(zip(k.tolist(), null.tolist())) or find(k, null))
    got = [row for batch in S._read_back(shard, batch_ids=4) for row in zip(*batch)]
    assert asked == [(0, True), (7, False), (9, False), (12, False)]
    assert collections.Counter((None if null else int(k), c) for k, null, _, _, c in got) == collections.Counter((k, crc(tok(t))) for k, t in rows)
    assert [int(r[2]) for r in got] == np.cumsum([0, *(int(r[3]) for r in got)])[:-1].tolist()
    monkeypatch.setattr(shard, "find", lambda k, null: np.roll(find(k, null), 1))  # a wrong answer is used, and noticed
    with pytest.raises(ValueError):
        list(S._read_back(shard))
    shard.close()
