"""From raw documents to token ids in five stages, each a table that the next one reads.

quality rules -> near-duplicate removal -> substring deduplication ->
benchmark decontamination -> byte-level BPE encoding (checked by decoding).

Defined results, for every stage: an empty table gives an empty one; other
columns pass through whatever their names; rows without an id, or with equal
ids, are judged each by its own text (rows with equal id and text alike).
``quality`` drops rows with null, empty or short texts. ``near_duplicates``
keeps them, as nothing is like them. ``repeated_passages`` keeps texts shorter
than a window and drops those that lose every word. ``decontamination`` keeps
rows without words. ``encoding`` gives a null text no ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bytebpe, decontaminate, kit, linequality, neardup, substring


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars as the text now is, in its place and type."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, without the lines that are too frequent on their host."""
    return _sized(linequality.cleaned(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that already stand in an earlier document."""
    return _sized(substring.remove_repeats(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out, (ids, digest) = bytebpe.encoded_and_verified(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", F.col(ids).alias("ids"), F.size(ids).cast("long").alias("n_tokens"), F.col(digest).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kit.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Sentencepiece merges and connected components of estimated links have no SQL form; tests compare with brute force.
ORACLE_SQL = None
