"""A training-corpus pipeline of five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``. The models of the first two stages and
of the mixing are learned from the labelled rows of the given tables that are
not held out, so a stage decides alike whatever the stages before it dropped.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, ngram_join, packing, quality_classifier, quality_rules
from tessera.llm.queries import END_ID, TOKENIZER
from tessera.llm.store import materialise


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    forest = quality_classifier.learn(*_tables(spark, sf_dir))
    return quality_classifier.score(docs, forest).where("predicted = 1").select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    forest = quality_rules.learn(*_tables(spark, sf_dir))
    return quality_rules.judge(docs, forest).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    texts, labels = _tables(spark, sf_dir)
    labels = labels.where(~quality_classifier.held_out(F.col("doc_id")))
    domains = labels.select("doc_id", mixing.domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    return mixing.expand(mixing.mix(docs, domains, labelled=texts), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", deduplicate),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = _tables(spark, sf_dir)[0]
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name.replace(" ", "-"))
    return docs


#: Tree models and tokenizers have no SQL form; the tests hold a brute-force version against it.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
