"""From raw documents to token ids: language, exact copies, near copies, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyferry.llm import bpe, exact_dedup, language, mixing, ngram_join
from keyferry.llm.common import held_out, tidy
from keyferry.llm.queries import MIX_BUDGET, MIX_POWERS, MIX_ROUNDS
from keyferry.session import cut_lineage, prepare

ORACLE_SQL = None  # trained weights and byte-pair merges are beyond SQL; tests compare with brute force


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those the network takes for text in no language."""
    tidy(prepare(spark))
    return language.keep_identified(docs, language.fit(docs.where(~held_out("doc_id")), noise=True))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the longest stays."""
    tidy(prepare(spark))
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, one stays."""
    tidy(prepare(spark))
    return ngram_join.one_of_each(docs, words=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and forms come near their target shares."""
    tidy(prepare(spark))
    return mixing.sample(docs, MIX_POWERS, rounds=MIX_ROUNDS, budget=MIX_BUDGET)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed), and the digest of what the ids decode to."""
    out = bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
