"""The corpus pipeline: toxicity, quality, near-duplicates, secrets, packing, each on what the stage before kept.

What every stage does with odd rows: a null text counts as empty and leaves as it came; a text of any length is read whole; rows that repeat an id
or a whole row are judged row by row, but for near-duplicates, where one row of a group stays; other columns of ``documents`` are kept, whatever
their names. Without rows in ``documents`` a stage gives none; without labels of both classes outside the held-out fold nothing is
learned: then toxicity rejects nothing if no label is toxic, and quality rejects nothing if none is bad.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark.llm import packing, quality, secrets, simhash, toxicity
from perispark.llm.common import fresh, read
from perispark.llm.queries import END_ID, TOKENIZER, WINDOW_TOKENS
from perispark.session import use_checkpoint_dir

ORACLE_SQL = None  # trained scores, hashes and token ids are beyond SQL; tests/llm/test_pipeline.py checks each stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; a score at the threshold is rejected, an empty text scores like any other."""
    score = fresh(docs, "_score")[0]
    scorer = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.add_score(docs, scorer, score).where(F.col(score) < toxicity.TOXIC_FROM).drop(score)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score from the quality threshold up; one at the threshold stays, as does an empty text if its score does."""
    score = fresh(docs, "_score")[0]
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.add_score(docs, model, score).where(F.col(score) >= quality.KEEP_FROM).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints: the one with the smallest id, then the smallest fingerprint.

    Documents without an id stay only if their group has none with one; empty and null texts are one group.
    """
    return simhash.deduplicate(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in a text replaced by a mark (overlapping ones share it); ``n_chars`` follows, nulls stay."""
    return secrets.redact(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and the windows they are packed in; an empty or null text is one piece of the end token."""
    return packing.pack(docs, TOKENIZER, WINDOW_TOKENS, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's rows are written to the shared folder and read again by the next."""
    folder = use_checkpoint_dir(spark)
    stamp = spark.sql("SELECT uuid()").first()[0]
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(folder, f"pipeline-{stamp}", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
