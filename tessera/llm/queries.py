"""The registered queries of this subpackage: each applies one operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, chat_format, embedding_dedup, mixing, ngram_join, packing, quality_classifier, quality_rules, sharding, token_store,
               url_filters, warc, whitening)
from .store import materialise

TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    forest = quality_classifier.learn(docs, _read(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, forest, keep=["doc_id"])
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    forest = quality_rules.learn(docs, _read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, forest, keep=["doc_id"])


#: (host, path, verdict): fixed values of the contract.
HOST_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a page's path names the document it shows; its labels
    (low quality or toxic) label the url for the rules to be mined."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_filters.path_of(F.col("url")), "/([0-9]{1,18})[^/]*/?$", 1)
    labels = _read(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    labelled = pages.select("url", number.try_cast("long").alias("shown"))
    labelled = labelled.join(labels, F.col("shown") == F.col("doc_id")).select("url", "block")
    return url_filters.judge(pages, HOST_RULES, url_filters.mine_rules(labelled))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_shards(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return token_store.read_shards(manifest).withColumnRenamed("key", "doc_id")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(_read(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains are those that the labels name; held-out rows are not learned from."""
    labels = _read(spark, sf_dir, "labels").where(~quality_classifier.held_out(F.col("doc_id")))
    domains = labels.select("doc_id", mixing.domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
    return mixing.mix(_read(spark, sf_dir, "documents"), domains, keep=["doc_id"])


def op7_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave(_read(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                      F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_pq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op9_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], table.schema)
    segs = materialise(chat_format.segments(table.unionByName(more)), "chat-segments")
    return chat_format.digests(segs, materialise(chat_format.examples(segs), "chat-examples"))


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op12_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = materialise(warc.read_records(warc.write_archives(_read(spark, sf_dir, "pages"))), "warc-records")
    own, first = F.col("response"), F.col("original")
    return warc.assemble(records).select(
        F.col("key").alias("page_id"), F.coalesce(own["payload_bytes"], first["payload_bytes"]).alias("payload_bytes"),
        own["payload_digest"].alias("payload_digest"), "record_type", first["key"].alias("refers_to"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_verdicts": op3_url_verdicts,
    "op4_token_shards": op4_token_shards,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_soft_mixing": op6_soft_mixing,
    "op7_interleaved_shards": op7_interleaved_shards,
    "op8_pq_near_duplicates": op8_pq_near_duplicates,
    "op9_prefix_target_chat": op9_prefix_target_chat,
    "op10_pack_sequences": op10_pack_sequences,
    "op11_token_alignment": op11_token_alignment,
    "op12_spectrum_whitening": op12_spectrum_whitening,
    "op13_warc_captures": op13_warc_captures,
}



def _escaped(column: str, header: bool = False) -> str:
    """The escape of ``chat_format`` in SQL."""
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for c in chat_format.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return f"replace({out}, chr(10), '\\' || chr(10))" if header else out


_FRAME = len(chat_format.START) + len(chat_format.END) + 2

ORACLE: dict[str, str] = {
    "op9_prefix_target_chat": f"""
with t as (select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s as (select conv_id, count(*) as n_turns,
  string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' order by turn nulls first, role nulls first, text nulls first) as turns,
  coalesce(string_agg(coalesce(text, ''), '' order by turn nulls first, role nulls first, text nulls first) filter (where role = 'assistant'), '') as loss,
  sum({_FRAME} + length({_escaped('role', True)}) + length({_escaped('text')})) as formatted from t group by conv_id)
select conv_id, cast(n_turns as bigint) as n_turns, sha256(turns) as turns_sha256, cast(length(loss) as bigint) as loss_chars,
  sha256(loss) as loss_sha256, cast(formatted as bigint) as formatted_chars from s""",
}
