"""Corpus pipeline: the stages that turn ``documents`` into encoded training data.

Every stage takes the table that the stage before wrote, works on all of it and
returns the columns of ``documents``; the last one returns the encoded rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import bpe, language_id
from tabspark.llm.exact_dedup import exact_dedup
from tabspark.llm.mixing import mixed_documents
from tabspark.llm.sampling import held_out
from tabspark.llm.simhash import near_dedup
from tabspark.session import stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; a null text or one without a letter (``und``) goes."""
    model = language_id.fit(docs.filter(~held_out()))
    return language_id.identify(docs, model).filter(f"lang_pred <> '{language_id.UND}'").select(
        *[f"`{c}`" for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (3-word shingles, 2 bits) the row with the smallest doc_id."""
    return near_dedup(docs, shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian uint32) and whether they decode to the text."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY),
                       public_tokenizers.PATTERN, verify=True)
    return coded.drop("text")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: The language model can't be stated in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
