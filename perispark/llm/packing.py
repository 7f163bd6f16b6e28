"""Packing of token sequences by minimum bin slack.

Every text is cut into windows of ``capacity`` tokens; what is left over is packed. Only how many remainders there are of
each length matters for that: a table of at most ``capacity`` counts at any corpus size. For each window the largest
remaining length is set, and a subset-sum dynamic program over bitsets (bit s: a multiset with sum s exists) finds the
multiset of remaining lengths that comes closest to capacity; walking the bitsets backwards gives its counts. The pattern
is used as often as its counts allow, so there are a few thousand patterns at most. Documents then find their window by
their rank among the remainders of equal length, in a join with the pattern table.

Defined results: a null or empty text is one piece that holds only the end token; repeated rows are packed as rows of
their own; an empty table gives no pieces; extra columns are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from perispark.llm.bpe import PATTERN, backtracking_encoder, vocabulary
from perispark.llm.common import cut_lineage, map_columns

PATTERN_SCHEMA = "length int, first bigint, last bigint, pattern bigint, per_window int, at int, base bigint"


@lru_cache(maxsize=2)
def library_encoder(path: str):
    """Whole texts to ids as bytes, one encoder per worker process.

    tiktoken merges by the vocabulary of the tokenizers file and gives the ids that the tokenizers library gives (a test
    holds them against it), in a third of its time. Its regular expressions give up on a run of about a million white-space
    characters; such a text goes whole to the backtracking encoder, which gives the same ids.
    """
    import tiktoken

    known = vocabulary(path)
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=known.ids, special_tokens=known.added)

    def encode(text: str) -> bytes:
        try:
            ids = encoding.encode(text, allowed_special="all", disallowed_special=())
        except ValueError:
            return backtracking_encoder(path)(text)
        return np.array(ids, dtype="<u4").tobytes()

    return encode


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens; all pieces but a document's last fill a window."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(texts):
        encode, found = library_encoder(path), []
        for text in texts:
            ids = encode(text or "") + end
            total = len(ids) // 4
            found.append([{"start": s, "length": min(capacity, total - s), "ids_crc32": zlib.crc32(ids[4 * s:4 * (s + capacity)]), "doc_tokens": total}
                          for s in range(0, total, capacity)])
        return {"pieces": found}

    rows = map_columns(docs.select("doc_id", "text"), ["text"], "pieces array<struct<start:bigint,length:int,ids_crc32:bigint,doc_tokens:bigint>>", run, keep=["doc_id"])
    return rows.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length fill one window closest to ``capacity``, the largest length among them.

    Lengths are taken in powers of two up to their counts; ``states`` keeps the bitset before each step, so the counts can
    be read off backwards. The first state that holds a full window ends the search.
    """
    largest = max(counts)
    room, mask = capacity - largest, (1 << (capacity - largest + 1)) - 1
    reach, states = 1, []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length] - (length == largest), room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(step, left)
            states.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {largest: 1}
    for length, take, before in reversed(states):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Window patterns and how often each is used, until no remainder is left."""
    left, found = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        chosen = fill(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        found.append((chosen, times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return found


def pattern_rows(counts: dict[int, int], capacity: int) -> list[tuple]:
    """Rank ranges of each length: the pattern they go to, their place in it, and the pattern's first window."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for i, (chosen, times) in enumerate(patterns(counts, capacity)):
        at = 0
        for n in sorted(chosen, reverse=True):
            first = used.get(n, 0)
            used[n] = first + chosen[n] * times
            rows.append((n, first, used[n], i, chosen[n], at, base))
            at += n * chosen[n]
        base += times
    return rows


def rank_within(df: DataFrame, key: str, spread: list[str], order: list[str], buckets: int) -> DataFrame:
    """Add ``rank``, gapless from 0 among the rows of equal ``key``.

    Rows are numbered inside hash buckets of a key, and the counts of the buckets before are added, so a key that holds a
    third of all rows is numbered by many tasks.
    """
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    counts = cut.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(key).orderBy("_bucket")) - F.col("_n")).drop("_n")
    numbered = cut.withColumn("_in", F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order)) - 1)
    return numbered.join(before, [key, "_bucket"]).withColumn("rank", (F.col("_before") + F.col("_in")).cast("bigint")).drop("_bucket", "_before", "_in")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it."""
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, path, capacity, end_id))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    table = spark.createDataFrame(pattern_rows(counts, capacity), T.StructType.fromDDL(PATTERN_SCHEMA))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranked = rank_within(pieces, "length", ["doc_id", "start", "ids_crc32"], ["doc_id", "start", "ids_crc32", "doc_tokens"], buckets)
    # the table has at most `capacity` lengths in each of a few thousand patterns, whatever the corpus
    placed = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (ranked["rank"] >= table["first"]) & (ranked["rank"] < table["last"])).drop(table["length"])
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("base") + F.floor(nth / F.col("per_window"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + nth % F.col("per_window") * F.col("length")).cast("bigint").alias("offset"))
