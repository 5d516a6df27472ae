"""Mixing to target weights with soft domain membership.

A softmax classifier learned from a labelled table predicts how likely each
document belongs to each domain. Document rates r >= 0 are then fitted so that
the expected tokens of every domain meet their targets: with token counts t
and posteriors P, minimise

    |sum_i r_i t_i P_i - target|^2  with a small pull of every r_i towards 1

by distributed projected gradient. A gradient step needs one vector of domain
totals, an aggregate over all documents; the step is scaled per document by
its tokens and over domains by the (small) curvature matrix, so that few
rounds are needed. A document's rate is a function of its posteriors and the
steps taken, so no rates are stored between rounds. Rates turn into whole
copies by a seeded hash of the document, with the rate as expectation.

The classifier uses which telling words a text holds, fitted on the driver to
at most ``SAMPLE_ROWS`` labelled documents; the weights (at most ``WORDS`` rows
for each domain) are all that tasks get.

Defined cases: a null text has no tokens and gets rate 1 like a document of
unknown domain; a domain without labelled rows is unknown and left out, its
target share is dealt to the others; without any labelled rows, or if no
document has tokens, all rates are 1; rows that repeat (same id and text) get
the same rate and copies; an empty table gives no rows; columns of the input
named like the output are replaced, others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from . import words as W
from .store import materialise, prepare

SAMPLE_ROWS = 8_000
STEPS = 200
WORDS = 2_000
LEAST_Z = 5.0
ROUNDS = 12
RIDGE = 1e-3
SEED = 97
#: Domains of the labelled table and their shares of all tokens.
TARGETS = {"clean": 0.985, "toxic": 0.01, "low": 0.005}


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain that the labels name; null without labels."""
    return F.when(quality == 0, "low").when(toxic == 1, "toxic").when(quality.isNotNull() & toxic.isNotNull(), "clean")


OWN = ["tokens", "posterior", "rate", "copies"]


@dataclass
class Membership:
    """A softmax over which of the telling words (by hash) a text holds."""

    domains: list[str]
    hashes: np.ndarray  # ascending
    weights: np.ndarray  # one row per hash, one column per domain
    bias: np.ndarray

    def posteriors(self, words: W.Words) -> np.ndarray:
        doc, which = present(words, self.hashes)
        k = len(self.domains)
        score = self.bias + np.stack([np.bincount(doc, weights=self.weights[which, j], minlength=len(words.counts)) for j in range(k)], axis=1)
        e = np.exp(score - score.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def present(words: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, position in ``hashes``) for each of the words that a text holds."""
    if not len(hashes) or not len(words.codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = word_keys(words)
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    at = np.where(hashes[at] == own, at, -1)[words.codes]
    hit = np.flatnonzero(at >= 0)
    doc = np.searchsorted(words.bounds, hit, side="right") - 1
    pair = np.unique(doc * len(hashes) + at[hit])
    return pair // len(hashes), pair % len(hashes)


def word_keys(words: W.Words) -> np.ndarray:
    return W.word_hashes(words.vocabulary)


def fit_membership(hashes: np.ndarray, bounds: np.ndarray, labels: np.ndarray, domains: list[str], steps: int = STEPS) -> Membership:
    """``hashes[bounds[i]:bounds[i + 1]]`` are the distinct words of text i.
    Telling words are those that a domain's texts hold more often than other
    texts by LEAST_Z standard errors, at most WORDS for each domain; softmax
    regression on them by Adam, with a small penalty. Domains weigh the same
    in the steps, and the bias restores their shares."""
    n, k = len(labels), len(domains)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    every, cell = np.unique(hashes, return_inverse=True)
    size = np.bincount(labels, minlength=k)
    held = np.stack([np.bincount(cell[labels[doc] == j], minlength=len(every)) for j in range(k)], axis=1)
    told = np.zeros(len(every), bool)
    p = held.sum(1) / n
    for j in range(k):
        rest = max(1, n - size[j])
        z = (held[:, j] / size[j] - (held.sum(1) - held[:, j]) / rest) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / size[j] + 1 / rest))
        best = np.argsort(-z, kind="stable")[:WORDS]
        told[best[z[best] >= LEAST_Z]] = True
    known = told[cell]
    doc, cell = doc[known], (np.cumsum(told) - 1)[cell[known]]
    share = size / n
    y = np.eye(k)[labels]
    weight = (1.0 / (k * share))[labels][:, None] / n
    m_ = int(told.sum())
    w = np.zeros((m_, k))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        s = np.stack([np.bincount(doc, weights=w[cell, j], minlength=n) for j in range(k)], axis=1)
        e = np.exp(s - s.max(1, keepdims=True))
        g = (e / e.sum(1, keepdims=True) - y) * weight
        grad = np.stack([np.bincount(cell, weights=g[doc, j], minlength=m_) for j in range(k)], axis=1) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Membership(domains, every[told], w, np.log(share))


def learn(docs: DataFrame, domains: DataFrame, names: list[str], key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Membership | None:
    """``domains``: (key, domain) rows. Learned from at most ``rows`` ids of the
    smallest hash, whose word hashes are all that the driver gets; None where
    no document has a label."""
    prepare(docs.sparkSession)
    ids = domains.where(F.col(key).isNotNull() & F.col("domain").isin(names)).groupBy(F.col(key).alias("_id")).agg(F.min("domain").alias("_domain"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    sample = docs.join(F.broadcast(ids), F.col(key) == F.col("_id")).select(F.xxhash64("_id", text).alias("id"), F.col("_domain").alias("domain"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                words = W.split(W.texts_of(part.column("text")), lower=True)
                own = word_keys(words).view(np.int64)[words.codes]
                lists = pa.array([np.unique(own[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("domain"), lists], names=["id", "domain", "words"])

    found = sample.mapInArrow(run, "id long, domain string, words array<long>").limit(rows).toArrow().combine_chunks()
    found = found.take(pc.sort_indices(found, [("id", "ascending"), ("domain", "ascending")]))
    seen = found.column("domain").to_pylist()
    present_ = [d for d in names if d in set(seen)]
    if not present_:
        return None
    lists = found.column("words").combine_chunks()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return fit_membership(hashes, np.concatenate([[0], np.cumsum(counts)]), np.array([present_.index(d) for d in seen]), present_)


def members(docs: DataFrame, model: Membership | None, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``tokens`` (words) and ``posterior``
    (one number per domain of the model; empty without one)."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (*OWN, text)]
    schema = StructType([docs.schema[c] for c in kept]).add("tokens", "long").add("posterior", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "_text"):
                words = W.split(W.texts_of(part.column("_text")), lower=True)
                p = model.posteriors(words) if model else np.zeros((len(words.counts), 0))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(words.counts), lists], names=[*kept, "tokens", "posterior"])

    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)


def _state(rows: DataFrame, rate: Column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the given rates, and the curvature
    sum t P P' over documents whose rate is free: one aggregate."""
    rows = rows.withColumn("_rate", rate)
    t, r = F.col("tokens"), F.col("_rate")
    p = [F.col("posterior")[j] for j in range(k)]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    out = rows.agg(*[F.sum(t * r * p[j]).alias(f"m{j}") for j in range(k)],
                   *[F.sum(F.when(r > 0, t * p[a] * p[b])).alias(f"h{a}_{b}") for a, b in pairs]).first()
    h = np.zeros((k, k))
    for i, (a, b) in enumerate(pairs):
        h[a, b] = h[b, a] = float(out[k + i] or 0.0)
    return np.array([float(out[j] or 0.0) for j in range(k)]), h


def _replay(duals: list[np.ndarray], k: int, ridge: float) -> Column:
    """A document's rate after the given steps, from its posteriors alone: the
    same projected steps as the fit has taken."""
    p = F.col("posterior")
    rate = F.lit(1.0)
    for u in duals:
        pull = sum((F.lit(float(u[j])) * p[j] for j in range(k)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate * (1.0 - ridge) + ridge - pull)
    return rate


def fit_rates(rows: DataFrame, shares: dict[str, float], domains: list[str], total: float | None = None, rounds: int = ROUNDS,
              ridge: float = RIDGE) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``rows`` (with tokens and posterior) and ``rate``; also the domains'
    targets and what the rates give. ``total`` tokens are wanted, by default as
    many as leave the domain of the largest share its own."""
    k = len(domains)
    if not k:
        return rows.withColumn("rate", F.lit(1.0)), np.zeros(0), np.zeros(0)
    mass, h = _state(rows, F.lit(1.0), k)
    if not mass.sum():
        return rows.withColumn("rate", F.lit(1.0)), np.zeros(k), mass
    share = np.array([shares[d] for d in domains])
    share = share / share.sum()
    main = int(share.argmax())
    wanted = share * (total if total is not None else float(mass[main] / share[main]))
    duals: list[np.ndarray] = []
    best = (np.inf, [], mass, h)
    sums, scale = mass, 1.0
    for _ in range(rounds):
        gap = sums - wanted
        if gap @ gap < best[0]:
            best = (float(gap @ gap), list(duals), sums, h)
        else:  # too far past the bound at zero: a shorter step from the best point
            scale /= 2
        if best[0] <= (1e-6 * wanted.sum()) ** 2:
            break
        _, duals, sums, h = best
        step = np.linalg.solve(h + 1e-9 * max(np.trace(h), 1.0) * np.eye(k), sums - wanted)
        duals = [*duals, scale * step]
        sums, h = _state(rows, _replay(duals, k, ridge), k)
    gap = sums - wanted
    duals, sums = (duals, sums) if gap @ gap < best[0] else (best[1], best[2])
    rate = F.when(F.col("tokens") > 0, _replay(duals, k, ridge)).otherwise(F.lit(1.0))
    return rows.withColumn("rate", rate), wanted, sums


def copies_of(rate: Column, *identity: Column, seed: int = SEED) -> Column:
    """A whole number with the rate as its expectation, the same for the same
    identity and seed."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + draw).cast("long")


def mix(docs: DataFrame, domains: DataFrame, shares: dict[str, float] | None = None, key: str = "doc_id", text: str = "text",
        keep: list[str] | None = None, total: float | None = None, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``), tokens, posterior, rate and copies.
    The classifier learns from ``labelled``, by default ``docs`` itself."""
    shares = shares or TARGETS
    model = learn(docs if labelled is None else labelled, domains, list(shares), key, text)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in OWN]
    rows = docs.select(*kept, F.col(text).alias("_body"), F.xxhash64(key, text).alias("_identity"))
    rows = materialise(members(rows, model, "_body"), "mix-members")
    rows, _, _ = fit_rates(rows, shares, model.domains if model else [], total)
    return rows.withColumn("copies", copies_of(F.col("rate"), F.col("_identity"))).select(*kept, *OWN)


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as ``copies`` says."""
    return mixed.where("copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select(*columns)
