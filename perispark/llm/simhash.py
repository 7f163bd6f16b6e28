"""SimHash fingerprints of word shingles, and groups of fingerprints at three or fewer differing bits.

Fingerprints are linked through deletion variants: the 64 bits are cut into two segments, so of two fingerprints that
differ in at most three bits one segment differs in at most one. Each segment is indexed once per wildcard place (32 + 32
variants); an equality of variants makes a candidate, which is then verified. A variant that very many fingerprints share
is cut again, in the bits not fixed yet, by the same rule: 32 bits, then 16. After that at most eleven bits are free, so
no group holds more than 2,048 different fingerprints, however many copies there are. Groups send one link per member
instead of all pairs.

Defined results: a text without words has fingerprint zero and is linked like any other; null text counts as empty; equal
texts have equal fingerprints; repeated rows stay rows of their own; a missing doc_id never names a component unless all
ids of the component are missing; texts of any length are read whole; an empty table stays empty; columns of other names
stay where a function keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, fresh, map_columns
from perispark.llm.graph import components

SHINGLE_WORDS, SEED, MOST_BITS = 3, 42, 3
GROUP = 1024  # members up to which a variant's group is compared at once
BLOCK = 1 << 16  # shingles counted at once


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text as an unsigned 64-bit number: each bit is set if it is in over half the shingle hashes."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    span = min(SHINGLE_WORDS, len(words))
    starts, stops = (ends - lengths + 1)[:len(words) - span + 1].tolist(), ends[span - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + BLOCK], stops[k:k + BLOCK])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def add_fingerprint(docs: DataFrame, text: str = "text", out: str = "bits", keep: list[str] | None = None) -> DataFrame:
    def run(texts):
        return {out: np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)}

    return map_columns(docs, [text], f"`{out}` bigint", run, keep=keep)


def variants(points: DataFrame, width: int) -> DataFrame:
    """``key``, ``bits``, ``rest``: one row per wildcard place of the two halves of the ``width`` low bits of ``rest``.

    ``rest`` comes out as the other half, the bits that the key leaves open.
    """
    half = width // 2
    low = (1 << half) - 1
    cut = points.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    one = f"(shiftrightunsigned(rest, CASE WHEN v < {half} THEN 0 ELSE {half} END) & {low}L)"
    other = f"(shiftrightunsigned(rest, CASE WHEN v < {half} THEN {half} ELSE 0 END) & {low}L)"
    masked = f"({one} & ~shiftleft(1L, v % {half}))"
    key = f"shiftleft(CAST(v AS BIGINT), 32) | {masked}" if "key" not in points.columns else f"xxhash64(key, v, {masked})"
    return cut.select(F.expr(key).alias("key"), "bits", F.expr(other).alias("rest"))


def _star(bits: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> None:
    """Links from every member of a group of distinct ``bits`` to the first one of its connected part."""
    near = np.bitwise_count((bits[:, None] ^ bits[None, :]).view(np.uint64)) <= MOST_BITS
    open_ = np.ones(len(bits), dtype=bool)
    while open_.any():
        part = np.zeros(len(bits), dtype=bool)
        front = np.array([np.argmax(open_)])
        part[front] = True
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & ~part)
            part[front] = True
        open_ &= ~part
        at = bits[part]
        a.append(np.full(len(at) - 1, at[0], dtype=np.int64))
        b.append(at[1:])


def _groups(most: int):
    """Links (``a``, ``b``) of the groups of up to ``most`` members, and larger groups' keys (``a`` null, ``b`` the key).

    Rows come ordered by key, so a group is a run, which may go over several batches; of a run the task keeps ``most``
    members and those of one batch at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # members of the run that is still open, and how many it has had
        open_key = None

        def close(a: list, b: list, hot: list) -> None:
            if size > most:
                hot.append(open_key)
            elif size > 1:
                _star(np.unique(np.concatenate(held)), a, b)

        def links(a: list, b: list, hot: list) -> pa.RecordBatch:
            ends = pa.array(np.concatenate([np.empty(0, np.int64), *a]))
            ends = pa.concat_arrays([ends, pa.nulls(len(hot), pa.int64())])
            return pa.RecordBatch.from_arrays([ends, pa.array(np.concatenate([np.empty(0, np.int64), *b, np.array(hot, dtype=np.int64)]))], names=["a", "b"])

        for batch in batches:
            key, bits = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(key):
                continue
            a, b, hot = [], [], []
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            # the first run may go on from the batch before, the last one may go on in the next
            if size and key[0] == open_key:
                if size <= most:
                    held.append(bits[:stops[0]].copy())
                size += int(stops[0])
                starts, stops = starts[1:], stops[1:]
            if len(starts):
                close(a, b, hot)
                lengths = stops - starts
                two = np.flatnonzero(lengths[:-1] == 2)
                left, right = bits[starts[two]], bits[starts[two] + 1]
                near = (np.bitwise_count((left ^ right).view(np.uint64)) <= MOST_BITS) & (left != right)
                a.append(left[near])
                b.append(right[near])
                for i in np.flatnonzero(lengths[:-1] > 2).tolist():
                    if lengths[i] > most:
                        hot.append(int(key[starts[i]]))
                    else:
                        _star(np.unique(bits[starts[i]:stops[i]]), a, b)
                open_key, size, held = int(key[-1]), int(lengths[-1]), [bits[starts[-1]:].copy()]
            yield links(a, b, hot)
        a, b, hot = [], [], []
        close(a, b, hot)
        yield links(a, b, hot)

    return run


def near_links(points: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) whose components are those of all pairs of distinct ``bits`` at ``MOST_BITS`` bits or fewer.

    Variants are shuffled once: dealt and ordered by key, a group is a run of rows, compared where it lies. Only groups of
    more than ``GROUP`` members are cut again, from their keys.
    """
    found, width = None, 64
    # a row becomes 64: spread rows by number, as their bytes alone would fit a task or two
    parts = max(1, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left = points.select("bits", F.col("bits").alias("rest")).repartition(parts, "bits")
    while True:
        keyed = variants(left, width)
        last = width == 16
        runs = keyed.select("key", "bits").repartition(parts, "key").sortWithinPartitions("key")
        # at the last cut no group holds more than 2,048 different members
        seen = cut_lineage(runs.mapInArrow(_groups(1 << 62 if last else GROUP), "a bigint, b bigint"))
        here = seen.where("a IS NOT NULL")
        found = here if found is None else found.unionByName(here)
        hot = seen.where("a IS NULL").select(F.col("b").alias("key"))
        if last or hot.isEmpty():
            return found
        left = cut_lineage(keyed.join(hot, "key"))
        width //= 2


def rooted(docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``bits``; and ``bits``, ``first_id``, ``root`` of each distinct fingerprint, with one root per group."""
    marked = cut_lineage(add_fingerprint(docs, keep=keep or ["doc_id"]))
    points = cut_lineage(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    roots = components(near_links(points))
    return marked, points.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))


def groups(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``bits`` and ``component_id``, the smallest doc_id reachable over links."""
    marked, named = rooted(docs, keep)
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = cut_lineage(named.select("bits", "root").join(smallest, "root").select("bits", "component_id"))
    return marked.join(known, "bits")


def fingerprint_hex(bits: str = "bits"):
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id, then the smallest fingerprint, and one row of those that repeat it.

    A group without any id keeps the row with the smallest fingerprint. Groups are told apart by their root, not by an id,
    which may be missing or name several. Columns stay as they are, whatever their names; a null text counts as empty; texts of any
    length are read whole; an empty table stays empty.
    """
    bits, key, keep_id, keep_bits, keep_key = fresh(docs, "_bits", "_key", "_keep_id", "_keep_bits", "_keep_key")
    named = rooted(docs.select("doc_id", "text"))[1]
    first = named.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "bits")).alias("k"))
    keepers = cut_lineage(first.select(F.col("k.first_id").alias(keep_id), F.col("k.bits").alias(keep_bits))
                          .withColumn(keep_key, F.xxhash64(keep_id, keep_bits)))
    marked = add_fingerprint(docs, out=bits).withColumn(key, F.xxhash64("doc_id", bits))
    same = (F.col(key) == F.col(keep_key)) & F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(bits) == F.col(keep_bits))
    return marked.join(keepers, same, "left_semi").dropDuplicates([key, "doc_id", bits]).drop(bits, key)
