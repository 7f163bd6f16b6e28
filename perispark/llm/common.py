"""Helpers shared by the corpus operators: reading tables, Arrow passes over texts, cutting lineage, picking training rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perispark.session import find_package, use_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder, so that later steps and lost executors read them from there."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as keep it apart from the columns of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def map_columns(df: DataFrame, columns: list[str], fields: str, fn: Callable[..., dict], keep: list[str] | None = None) -> DataFrame:
    """Append the ``fields`` that ``fn`` makes of the named columns' values, Arrow batch by Arrow batch.

    ``fn`` takes one list per column and returns lists by field name. ``keep`` names the columns that stay
    (default: all); a kept column that clashes with a new one gives way.
    """
    find_package(df.sparkSession)
    added = T.StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c not in added.names]
    inputs = [c for c in columns if c not in kept]
    schema = T.StructType([df.schema[c] for c in kept] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        new = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added]
        for batch in batches:
            at = batch.schema.names
            made = fn(*[batch.column(at.index(c)).to_pylist() for c in columns])
            arrays = [batch.column(at.index(c)) for c in kept] + [pa.array(made[f.name], type=f.type) for f in new]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(at.index(c)) for c in kept] + new))

    return df.select(*[F.col(f"`{c}`") for c in kept + inputs]).mapInArrow(run, schema)


def fold_of(doc_id: Column | str) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; rows with remainder 0 are held out from training."""
    return F.crc32(F.encode((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), "UTF-8")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True for held-out documents; a missing id is never trained on and counts as held out."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(True))


SAMPLE_BYTES = 24 << 20  # of a class in a training sample


def within(sizes: list[tuple[int, int]], budget: int) -> list[int]:
    """Ids of those (id, bytes), in their order, that still fit into what the ones before have left of the budget."""
    found = []
    for i, size in sizes:
        if size <= budget:
            found.append(i)
            budget -= size
    return found


def training_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int, budget: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts outside the held-out fold, for fitting on the driver.

    Of each class the first ``per_class`` documents in the order of the MD5 of their id are candidates, and each is taken in
    whole or, if it does not fit into what is left of ``budget`` bytes, left out: so the sample is bounded at any table size
    and no text in it is cut. A document with contradicting or repeated label rows counts once, with its largest label; of
    rows that repeat its id, the text that comes first in order counts.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold_of("doc_id") != 0))
             .groupBy("doc_id").agg(F.max(label).alias("label")))
    text = F.coalesce(F.col("text"), F.lit(""))
    picked = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    few = cut_lineage(picked)  # at most 2 x per_class rows
    sizes = (docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.octet_length(text).alias("size")).join(F.broadcast(few), "doc_id")
             .groupBy("doc_id").agg(F.max("size").alias("size"), F.first("label").alias("label")))
    rows = sizes.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").collect()
    ids = [i for value in (0, 1) for i in within([(r.doc_id, r["size"]) for r in rows if r.label == value], budget)]
    sample = (docs.where(F.col("doc_id").isNotNull()).select("doc_id", text.alias("text"))
              .join(F.broadcast(few.where(F.col("doc_id").isin(ids))), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")))
    return [(r.text, int(r.label)) for r in sample.orderBy("doc_id").collect()]
