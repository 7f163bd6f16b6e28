"""The corpus operators on the driver's tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark.llm import bpe, chunks, collocations, decontamination, licenses, merkle, packing, quality, secrets, sharding, simhash, toxicity, vectors
from perispark.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WINDOW_TOKENS, END_ID = 2048, 1


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER, WINDOW_TOKENS, END_ID)


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"), 0.93)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compare_with_next(read(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), 40)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "documents").select("doc_id", licenses.document_path().alias("path"), "text")
    return licenses.scan(files).withColumn("cosine", F.round("cosine", 6))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_packing, op3_vectors, op4_quality, op5_chunks, op6_simhash, op7_sharding, op8_toxicity, op9_bpe, op10_licenses, op11_merkle,
                                op12_collocations, op13_decontamination)}
ORACLES: dict[str, str] = {"op3_vectors": vectors.ORACLE_SQL, "op7_sharding": sharding.oracle_sql(40), "op10_licenses": licenses.ORACLE_SQL,
                           "op11_merkle": merkle.oracle_sql(), "op12_collocations": collocations.oracle_sql(), "op13_decontamination": decontamination.oracle_sql()}
