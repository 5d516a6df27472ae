import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import chat_format as C
from tessera.llm import embedding_dedup as D

from ..conftest import SF_MID
from .test_ngram_join import components


def brute_links(ids, vectors, threshold):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links, pairs = collections.Counter(), []
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((i, j))
    comp = components(pairs, range(len(ids)))
    least = {}
    for i, c in comp.items():
        least[c] = min(least.get(c, 10 ** 9), ids[i])
    return {ids[i]: (links[i], least[comp[i]]) for i in range(len(ids))}


def clustered(n=700, d=24, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, n, 4):  # partners on both sides of the threshold
        x[i + 1] = x[i] + rng.normal(size=d) * rng.choice([0.2, 0.4, 0.6])
    x[300:340] = x[300] + rng.normal(size=(40, d)) * 0.25
    return x.astype(np.float32)


@pytest.mark.parametrize("block", [2048, 16])
def test_links_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_ROWS", block)
    x = clustered()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute_links([r[0] for r in rows], [r[1] for r in rows], 0.9)
    got = {r.vec_id: r for r in D.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert sum(n for n, _ in want.values()) > 200
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_of_probes_at_the_threshold():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = D.Index(x, len(x), 0.9)
    q = x[:1000]
    u = rng.normal(size=q.shape)
    u -= (u * q).sum(1)[:, None] * q
    y = 0.9 * q + np.sqrt(1 - 0.81) * u / np.linalg.norm(u, axis=1)[:, None]
    (hq, pq), (hy, py) = index.probes(q), index.probes(y)
    assert np.mean([hy[i] in pq[i] or hq[i] in py[i] for i in range(1000)]) == 1


def few_directions(kind, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    return x[:, :8] @ np.random.default_rng(1).normal(size=(8, 64)) if kind == "rank 8" else x / np.arange(1, 65)


@pytest.mark.parametrize("kind", ["rank 8", "1 / i"])
@pytest.mark.parametrize("rows", [51_000, 10_000_000])
def test_probes_lose_no_pair_where_vectors_vary_in_few_directions(kind, rows):
    x = few_directions(kind, 20_000, 2)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = D.Index(x, rows, 0.9)
    assert len(index.centres) == min(rows // D.LIST_ROWS, 2500)  # the most that the sample allows
    q = x[:1000]
    u = few_directions(kind, 1000, 3)
    u -= (u * q).sum(1)[:, None] * q
    y = 0.9 * q + np.sqrt(1 - 0.81) * u / np.linalg.norm(u, axis=1)[:, None]
    (hq, pq), (hy, py) = index.probes(q), index.probes(y)
    assert all(hy[i] in pq[i] or hq[i] in py[i] for i in range(1000))


@pytest.mark.parametrize("kind", ["rank 8", "1 / i"])
def test_every_link_is_found_where_vectors_vary_in_few_directions(spark, monkeypatch, kind):
    monkeypatch.setattr(D, "LIST_ROWS", 8)
    monkeypatch.setattr(D, "BLOCK_ROWS", 300)
    x = few_directions(kind, 2000, 4).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    assert near.sum() - len(x) > 500
    want = components(np.argwhere(near).tolist(), range(len(x)))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in D.near_duplicates(rows).collect()}
    assert [got[i].n_links for i in range(len(x))] == (near.sum(1) - 1).tolist()
    least = {}
    for i, c in want.items():
        least[c] = min(least.get(c, i), i)
    assert all(got[i].component_id == least[c] for i, c in want.items())


def test_the_table_distance_has_an_exact_bound():
    x = clustered().astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = D.Index(x, len(x), 0.9)
    codes, left = index.encode(x - index.centres[0])
    parts = index.left_out(x - index.centres[0], codes)
    loose, close = index.approximate(x, 0, codes) + left[:, None], index.approximate(x, 0, codes) + parts @ index.norms(x).T
    assert (x @ x.T <= close + D.TABLE_SLACK).all() and (close <= loose + D.TABLE_SLACK).all()
    some = np.array([3, 77, 400])
    assert np.allclose(index.approximate(x, 0, codes, rows=some), index.approximate(x, 0, codes)[:, some], atol=1e-6)


def test_odd_vectors(spark):
    v = [1.0, 0.0, 2.0]
    rows = [(1, v), (2, v), (3, [2.0, 0.0, 4.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]), (8, [float("nan"), 0.0, 2.0]),
            (9, [float("inf"), 0.0, 2.0]), (10, [1.0, 0.0]), (11, [5.0, 0.0]), (12, [-1.0, -0.0, -2.0]), (13, [1.0, -0.0, 2.0]), (14, [1e30, 0.0, 2e30])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           D.near_duplicates(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")).collect()}
    for i in (1, 2, 3, 13, 14):
        assert got[i] == (4, 1, i == 1)
    assert got[10] == (1, 10, True) and got[11] == (1, 10, False)
    for i in (4, 5, 6, 7, 8, 9, 12):
        assert got[i] == (0, i, True)
    assert D.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert D.near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 1


def test_op8_query(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").toPandas()
    x = np.stack(rows["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    comp, least = components(np.argwhere(near).tolist(), range(len(x))), {}
    for i, c in comp.items():
        least[c] = min(least.get(c, rows["vec_id"].max()), rows["vec_id"][i])
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.queries()["op8_pq_near_duplicates"](spark, SF_MID).collect()}
    assert got == {rows["vec_id"][i]: (near[i].sum() - 1, least[comp[i]]) for i in range(len(x))}


def brute_digests(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        replies = "".join(t[5] for t in turns if t[3] == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{t[3]}\n{t[5]}\n" for t in turns).encode()).hexdigest(),
                     len(replies), hashlib.sha256(replies.encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "\\", "\\<s>", "<\\s>", "<<SYS>>", "\\\\n\n", "", None, "é😀\r\n", "x" * 20_000, "$1 \\1 &amp;"]


@pytest.mark.parametrize("chunk", [1024, 2])
def test_digests_and_examples(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK_TURNS", chunk)
    rows = [(c, t, ["system", "user", "assistant", "a\nb\\", None][(c + t) % 5], HARD[(3 * c + t) % len(HARD)]) for c in range(12) for t in range(c)]
    rows += [(None, 0, "user", "hi"), (None, 1, "assistant", "yo"), (50, None, "assistant", "null turn"), (50, 1, "assistant", "b")]
    rows += [(60, 1, "assistant", "same")] * 3
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", segment int")
    segs = C.segments(table).cache()
    exs = C.examples(segs)
    got = {r.conv_id: r for r in C.digests(segs, exs).collect()}
    want = brute_digests(rows)
    assert set(got) == set(want)
    for conv, w in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == w
    text = collections.defaultdict(str)
    for s in sorted(segs.where("conv_id is not null").collect(), key=lambda s: (s.conv_id, s.position)):
        assert s.char_start == len(text[s.conv_id])
        text[s.conv_id] += s.segment
        inner = s.segment[len(C.START):-len(C.END) - 1]
        assert not any(c in inner for c in C.CONTROL)
    assert all(got[c].formatted_chars == len(t) for c, t in text.items())
    replies = {(r[0], r[1]) for r in rows}
    for e in C.render(segs, exs.where("conv_id < 12")).collect():
        assert e.text == text[e.conv_id][:len(e.text)]  # all turns before, then the reply
        assert C.parse(text[e.conv_id][:len(e.text)][e.text.rindex(C.START):])[0] == "assistant"
        assert e.loss_end <= len(e.text)
    assert exs.count() == sum(r[2] == "assistant" for r in rows) and replies
    assert C.digests(C.segments(spark.createDataFrame([], SCHEMA)), C.examples(C.segments(spark.createDataFrame([], SCHEMA)))).count() == 0


@pytest.mark.parametrize("column", ["context_end", "example_end", "loss_start"])
def test_wrong_spans_of_examples_show(spark, column):
    rows = [(1, t, ["user", "assistant"][t % 2], f"text {t}") for t in range(6)]
    segs = C.segments(spark.createDataFrame(rows, SCHEMA)).cache()
    exs = C.examples(segs)
    right = C.digests(segs, exs).first()
    wrong = C.digests(segs, exs.withColumn(column, F.col(column) + (F.col("target") == 3).cast("int")))
    if column == "loss_start":
        assert wrong.first().loss_sha256 != right.loss_sha256
    else:
        with pytest.raises(Exception, match="instead of"):
            wrong.collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROL, "\\", "<", "[", "|", "s>", "\n", "a", "|im_end|>"]), max_size=12).map("".join))
def test_unescape_undoes_the_escape(text):
    import re
    escaped = re.sub(f"({C._BREAK})", r"\1\\", text.replace("\\", "\\\\"))  # the same pattern as in SQL
    assert C.unescape(escaped) == text
    assert not any(c in escaped for c in C.CONTROL)


def test_op9_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF_MID}/conversations.parquet')")
    want = sorted(con.execute(E.oracle_sql()["op9_prefix_target_chat"]).fetchall())
    got = E.queries()["op9_prefix_target_chat"](spark, SF_MID).select(*[d[0] for d in con.description]).collect()
    assert sorted(map(tuple, got)) == want
    # and on hard texts
    rows = [(c, t, ["user", "assistant", "a\\b\n"][(c + t) % 3], HARD[(c + t) % len(HARD)]) for c in range(15) for t in range(4)]
    con.execute("drop view conversations")
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    own = [(-1, 0, "user", HARD[0]), (-1, 1, "assistant", HARD[0])]
    want = sorted(con.execute(E.oracle_sql()["op9_prefix_target_chat"]).fetchall())
    segs = C.segments(spark.createDataFrame(rows + own, SCHEMA)).cache()
    assert sorted(map(tuple, C.digests(segs, C.examples(segs)).collect())) == want


def test_op9_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", HARD[0]), (-1, 1, "assistant", HARD[0])]
    want = brute_digests(rows)
    got = E.queries()["op9_prefix_target_chat"](spark, SF_MID).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert all(r.formatted_chars > 0 for r in got)
