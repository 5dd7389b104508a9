"""The corpus operators as queries over the driver tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, prepare
from . import bpe, collocations, conversation_repair, embedding_dups, exact_dedup, language, mixing, ngram_join, pii, secrets, sql, token_counts, token_files, toxicity
from .common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The production mix: shares follow what is there, flattened, so that no source or language rules it.
MIX_POWERS = {"source": 0.5, "lang": 0.5, "topic": 0.7}
MIX_ROUNDS, MIX_BUDGET = 12, 0.5
END_ID = 1  # closes every document of the token files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_exact_dedup", sql.EXACT_DEDUP)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op3_bpe_round_trip")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    decoded = bpe.decode(encoded.withColumn("ids_sha256", F.sha2("ids", 256)), path, keep=("n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language.identify_held_out(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return out.withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "score", "predicted")


def _of_kind(kind: str):
    return F.filter("spans", lambda s: s["kind"] == kind)


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    counts = [F.size(_of_kind(k)).cast("bigint").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    terms = F.transform("terms", lambda t: F.struct(F.lit(pii.TERM).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    counts = [F.size(_of_kind(k)).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(base, terms)).alias("spans"))


@query("op7_ngram_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@query("op2_mixing", sql.mixing(MIX_POWERS, MIX_ROUNDS, MIX_BUDGET))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), MIX_POWERS, rounds=MIX_ROUNDS, budget=MIX_BUDGET)
    return out.withColumn("probability", F.round("probability", 6))


@query("op5_embedding_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_phrase_collocations", sql.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_token_files")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/keyferry/{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_files.checked(token_files.read(spark, path))


@query("op13_conversation_repair", sql.CONVERSATION_REPAIR)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.Repair(conversation_repair.damage(table(spark, sf_dir, "conversations"))).summary()
