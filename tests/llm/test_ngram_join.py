import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tessera.llm import ngram_join as J
from tessera.llm.components import connected

from ..conftest import SF_MID
from . import data

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TABLE))
    return frozenset(zip(*(w[k:] for k in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, width, percent):
    """(n_shingles, component) of each row, by all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    linked = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
              if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    comp = components(linked, range(len(rows)))
    ids = {}
    for i, c in comp.items():
        ids.setdefault(c, []).append(rows[i][0])
    least = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return [(len(s), least[comp[i]] if s else rows[i][0]) for i, s in enumerate(sets)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=60), min_size=2, max_size=10), st.integers(0, 2 ** 32), st.sampled_from([80, 90]))
def test_tree_finds_every_link_both_ways(lists, seed, percent):
    rng = np.random.default_rng(seed)
    sets = {tuple(sorted(set(x))) for x in lists}
    for x in list(sets):  # near copies
        y = [v for v in x if rng.random() > 0.06] + [100 + int(v) for v in rng.integers(0, 5, rng.integers(0, 3))]
        if y:
            sets.add(tuple(sorted(set(y))))
    sets = [np.array(x, np.int64) for x in sorted(sets)]
    want = {(i, j) for i in range(len(sets)) for j in range(len(sets))
            if i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
    root, found = J.join_sets(sets, percent)
    assert {(i, int(j)) for i, with_ in found for j in with_} == want
    assert root.tolist() == [components(want, range(len(sets)))[i] for i in range(len(sets))]
    sides = rng.integers(0, 2, len(sets))
    _, found = J.join_sets(sets, percent, sides)
    assert {(i, int(j)) for i, with_ in found for j in with_} == {(i, j) for i, j in want if sides[i] == 1 and sides[j] == 0}


@pytest.mark.parametrize("width,percent,small", [(3, 90, False), (5, 80, False), (5, 80, True)])
def test_odd_rows_equal_brute_force(spark, monkeypatch, width, percent, small):
    if small:  # blocks of a few sets, few frequent shingles: other paths, same result
        monkeypatch.setattr(J, "BLOCK_SHINGLES", 400)
        monkeypatch.setattr(J, "FREQUENT", 2)
        monkeypatch.setattr(J, "FREQUENT_ROWS", 50)
    rows = data.documents(60)
    docs = data.table(spark, rows).withColumnRenamed("n_chars", "component").withColumnRenamed("lang", "name")
    want = sorted((r[0] is None, r[0], *b) if r[0] is not None else (True, 0, b[0], b[1] if b[1] is not None else -1)
                  for r, b in zip(rows, brute([r[:2] for r in rows], width, percent)))
    got = sorted((False, r.doc_id, r.n_shingles, r.component_id) if r.doc_id is not None
                 else (True, 0, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in J.similar(docs, width, percent).collect())
    assert got == want


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 3000)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(150, rng.integers(0, 7), replace=False):
            w[at] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    want = brute(rows, 3, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert [got[i] for i in range(150)] == want and len({c for _, c in want}) > 5


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()][:400]
    rows = E.queries()["op5_ngram_jaccard"](spark, SF_MID).collect()
    assert len(rows) == 1000
    got = {r.doc_id: r for r in J.similar(spark.createDataFrame(docs, "doc_id long, text string"), 3, 90).collect()}
    for (i, _), b in zip(docs, brute(docs, 3, 90)):
        assert (got[i].n_shingles, got[i].component_id) == b


def test_keep_one(spark):
    rows = data.documents(60)
    kept = J.keep_one(data.table(spark, rows)).collect()
    want = brute([r[:2] for r in rows], J.WIDTH, J.PERCENT)
    wordless = sum(n == 0 for n, _ in want)
    assert sum(not (r.text or "").strip() for r in kept) == wordless
    full = [r for r in kept if (r.text or "").strip()]
    # a component whose smallest row has a null id stays as that row
    comps = {}
    for r, (n, c) in zip(rows, want):
        if n:
            comps.setdefault((c, r[0] is None and c is None), set()).add(r[0])
    assert len(full) == len({c for n, c in want if n})
    assert {r.doc_id for r in full if r.doc_id is not None} <= {r[0] for r in rows}
    assert J.keep_one(data.empty(spark)).count() == 0
    assert J.similar(data.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(7, i) for i in range(2000, 2100)]
    want = components([e for e in edges if e[0] != e[1]], {x for e in edges if e[0] != e[1] for x in e})
    got = {r.node_: r.component for r in connected(spark.createDataFrame(edges + [(None, 1), (3, None)], "a long, b long")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
