"""A pipeline of training-data operators over ``documents``: quality rules, near-duplicate removal, pseudonyms, mixing and
token ids. Every stage but the last takes and returns the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinara.llm import line_quality, mixing, ngram_join, pii
from opinara.llm.bpe import encode_documents
from opinara.llm.common import cut, spent

#: No SQL for near duplicates, keyed permutations or merges; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines that many documents of a source share go from the others, and n_chars follows.

    A null, empty or blank text is rejected; a null source is one source; rows that repeat a doc_id are judged each by its
    own text; very long texts are judged whole; other columns stay, whatever their names.
    """
    return line_quality.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of least doc_id: five-word shingles, Jaccard similarity 0.8 or more.

    Texts without words are in no group and stay, as do rows with a null doc_id; rows that repeat the least doc_id of a group
    all stay; other columns stay, whatever their names.
    """
    return ngram_join.one_of_each(docs, width=5, num=80, den=100)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become format-preserving pseudonyms, by the key that spark.opinara.pii.key names, or else by one that is
    drawn for this application and thrown away.

    Null texts stay null; equal texts stay equal; n_chars stays true, as lengths do not change but for mail addresses and
    dates said otherwise, of which it is the length before; other columns stay, whatever their names.
    """
    return pii.pseudonymise(docs, key=pii.passing_key(spark), counts=False)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document stays as often as the mix takes it.

    Texts without words go; null sources are one, the last; rows that repeat a doc_id share one decision; other columns
    stay, whatever their names.
    """
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids: their number and digest, and the digest of the bytes they decode to; a row for each row, a null text being
    empty."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remember=200_000)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("PII pseudonyms", private), ("source mixing", mixture), ("byte-level BPE", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = made = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, made = made, cut(stage(spark, made, sf_dir))
        if before is not docs:
            spent(before)
    return STAGES[-1][1](spark, made, sf_dir)
