"""Quality verdicts from rule statistics and monotone gradient-boosted trees.

Base counts of each whole text decide two plain rules (fewer than
``LEAST_WORDS`` words; more than half of the words in repeated 3-word
windows). Documents that pass get the trees' verdict: histogram
gradient-boosted trees over shares made of the counts, where symbols,
exclamation marks, capitals, repeated lines, words and windows may only
lower the score and distinct words only raise it. The trees are fitted on
the driver to a bounded sample of labelled rows that are not held out.

Defined cases: a null text has no words and fails the base rules; without
labelled rows every score is 0.5, so the base rules decide; rows that repeat
are all judged; an empty table gives no rows; columns of the input named like
the output are replaced, others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import boosting
from . import quality_classifier as Q
from . import text_stats as S
from . import words as W
from .store import prepare

LEAST_WORDS = 50
THRESHOLD = 0.3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: How a share may act on the score: -1 lowers, 1 raises, 0 either.
SHARES = {"log_words": 0, "mean_word": 0, "symbols": -1, "bangs": -1, "capitals": -1, "dup_lines": -1, "repeat_words": -1,
          "neighbours": -1, "distinct": 1}


def measure(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS (whole numbers) and SHARES of each text."""
    words = W.split(texts)
    n = words.counts
    chars = words.sums(np.fromiter(map(len, words.vocabulary), np.int64, len(words.vocabulary)))
    kinds = S.character_counts(texts)
    lines, repeats = S.repeated_lines(texts)
    windows = S.repeated_windows(words)
    counts = np.stack([n, chars, kinds["symbol"], repeats, windows], axis=1).astype(np.int64)
    some, all_ = np.maximum(n, 1), np.maximum(chars, 1)
    distinct, _ = S.vocabulary_use(words)
    shares = np.stack([np.log1p(n), chars / some, kinds["symbol"] / all_, kinds["bang"] / all_, kinds["upper"] / all_, repeats / np.maximum(lines, 1),
                       windows / some, S.neighbours_equal(words) / some, distinct / some], axis=1)
    return counts, shares.astype(float)


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeat = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * repeat > 50 * n)


def learn(docs: DataFrame, labels: DataFrame, **more) -> boosting.Forest:
    return Q.learn(docs, labels, lambda texts: measure(texts)[1], len(SHARES), tuple(SHARES.values()), **more)


def judge(docs: DataFrame, forest: boosting.Forest, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``), the counts, ``base_failed``,
    ``score`` and ``kept``."""
    prepare(docs.sparkSession)
    own = [*COUNTS, "base_failed", "score", "kept"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own]
    schema = StructType([docs.schema[c] for c in kept])
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")
    body = text if text in kept else "_text"
    rows = docs.select(*kept) if text in kept else docs.select(*kept, F.col(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, body):
                counts, shares = measure(W.texts_of(part.column(body)))
                failed, s = base_failed(counts), forest.score(shares)
                cols = [part.column(c) for c in kept] + [pa.array(counts[:, i]) for i in range(len(COUNTS))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(failed), pa.array(s), pa.array(~failed & (s >= THRESHOLD))], names=[*kept, *own])

    return rows.mapInArrow(run, schema)
