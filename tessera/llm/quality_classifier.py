"""Quality scores by histogram gradient-boosted trees over document statistics.

The trees are fitted on the driver to at most ``SAMPLE_ROWS`` labelled rows
(those of the smallest hash of the id), flattened into node arrays, sent to
all tasks (a few kilobytes) and walked for a batch of documents at a time.
Statistics come from whole texts; labels, ids, language and source are no
inputs.

Defined cases: a null text is an empty one, and an empty text gets a score
like any other (from zeros); labels of one id that differ count as the
higher; without labelled rows every score is 0.5; rows that repeat are all
scored; an empty table gives no rows; columns of the input named like the
output are replaced, others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import boosting
from . import text_stats as S
from . import words as W
from .store import prepare

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = ["log_words", "mean_word", "long_words", "distinct_share", "top_share", "neighbour_share", "repeat_share", "line_words",
            "repeated_line_share", "symbol_share", "bang_share", "upper_share", "digit_share", "stop_share", "other_share", "wide_share"]


def statistics(texts: pa.Array) -> np.ndarray:
    """Rows of FEATURES; zeros for an empty text."""
    words = W.split(texts)
    n = words.counts
    some = np.maximum(n, 1)
    size = np.fromiter(map(len, words.vocabulary), np.int64, len(words.vocabulary))
    chars = words.sums(size)
    all_ = np.maximum(chars, 1)
    distinct, top = S.vocabulary_use(words)
    kinds = S.character_counts(texts)
    lines, repeats = S.repeated_lines(texts)
    return np.stack([np.log1p(n), chars / some, words.sums((size > 12).astype(np.int64)) / some, distinct / some, top / some,
                     S.neighbours_equal(words) / some, S.repeated_windows(words) / some, n / np.maximum(lines, 1), repeats / np.maximum(lines, 1),
                     *(kinds[k] / all_ for k in ("symbol", "bang", "upper", "digit", "stop", "other", "wide"))], axis=1).astype(float)


def held_out(key: Column) -> Column:
    """True for the fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts with a label, of at most ``rows`` ids that are not held out."""
    ids = labels.where(F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("_id")).agg(F.max(label).alias("_label"))
    ids = ids.where(F.col("_label").isNotNull()).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.join(F.broadcast(ids), F.col(key) == F.col("_id")).select("_id", F.col(text).alias("text"), F.col("_label").cast("double").alias("label"))


def learn(docs: DataFrame, labels: DataFrame, statistics=statistics, n_features: int = len(FEATURES), monotone: tuple[int, ...] | None = None,
          label: str = "quality", key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> boosting.Forest:
    """Trees fitted to the labelled sample; the statistics are made on the cluster."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                x = statistics(W.texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    sample = labelled_sample(docs, labels, label, key, text, rows)
    id_type = sample.schema["_id"].dataType.simpleString()
    # an id may have several rows; still no more than the bound
    found = sample.mapInArrow(run, f"id {id_type}, label double, x array<double>").limit(rows).toPandas()
    found = found.sort_values(["id", "label"], kind="stable")
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, n_features))
    return boosting.fit(x, found["label"].to_numpy(dtype=float), monotone)


def score(docs: DataFrame, forest: boosting.Forest, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) and ``score``, the likelihood of
    label 1, and ``predicted`` (1 where the score reaches THRESHOLD)."""
    prepare(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    schema = StructType([docs.schema[c] for c in kept]).add("score", "double").add("predicted", "integer")
    body = text if text in kept else "_text"
    rows = docs.select(*kept) if text in kept else docs.select(*kept, F.col(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, body):
                s = forest.score(statistics(W.texts_of(part.column(body))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                                 names=[*kept, "score", "predicted"])

    return rows.mapInArrow(run, schema)
