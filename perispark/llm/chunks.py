"""Fingerprints from content-defined chunks.

A gear hash rolls over a text's UTF-8 bytes; a chunk ends where its top bits are zero. The mask is strict before the
normal chunk size and loose after it (normalised chunking), so sizes gather around the normal one, and as borders hang
on nearby bytes only, an insertion moves no border far from it. The fingerprint is the set of chunk digests with their
lengths; the length-weighted share of one set found in the other measures containment.

Defined results: a null text counts as empty; an empty text has an empty fingerprint; two empty texts are alike (1), an
empty and another are not (0); equal texts have equal fingerprints; a repeated chunk counts once. The document after the
last one is the first; a lone document is its own next. Documents without an id come after all others, repeated ids in the
order of their texts' hashes. Texts of any length are cut whole; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, NORMAL, MOST = 24, 64, 256  # bytes of a chunk
STRICT, LOOSE = np.uint32(0xFF000000), np.uint32(0xF0000000)  # 8 and 4 bits: two above and two below the 6 of the normal size
DIGEST_SEED = 5
SPAN = 1 << 20  # bytes hashed at once


def gear_table(seed: int = 20) -> np.ndarray:
    """256 random 32-bit numbers, from a rule: words of BLAKE2b over the seed and the byte."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([seed, b]), digest_size=4).digest(), "little") for b in range(256)], dtype=np.uint32)


GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: sum of the gears of the last 32 bytes, each shifted by its distance (mod 2**32).

    Built by doubling: sums over 2k bytes are those over k bytes plus those k bytes earlier, shifted by k.
    """
    total = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        if len(total) > k:
            total[k:] = total[k:] + (total[:-k] << np.uint32(k))  # the right side is made whole before it is stored
    return total


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    view, loose, strict = np.frombuffer(data, dtype=np.uint8), [], []
    for k in range(0, n, SPAN):
        lead = min(k, 31)
        hashes = gear_hashes(view[k - lead:k + SPAN])[lead:]
        at = np.flatnonzero((hashes & LOOSE) == 0)
        loose.append(at + (k + 1))
        strict.append((hashes[at] & STRICT) == 0)
    places, firm = np.concatenate(loose), np.concatenate(strict)
    places, tight = places.tolist(), places[firm].tolist()
    ends, start, i, j = [], 0, 0, 0
    while n - start > LEAST:
        least, normal, most = start + LEAST, start + NORMAL, min(start + MOST, n)
        while j < len(tight) and tight[j] < least:
            j += 1
        if j < len(tight) and tight[j] <= min(normal, most):
            end = tight[j]
        else:
            while i < len(places) and places[i] <= normal:
                i += 1
            end = places[i] if i < len(places) and places[i] < most else most
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def fingerprint(text: str) -> dict[int, int]:
    """Length in bytes by digest, over the distinct chunks of a text."""
    import xxhash

    data = text.encode("utf-8", "surrogatepass")
    found, start, digest = {}, 0, xxhash.xxh64_intdigest
    for end in chunk_ends(data):
        found[digest(data[start:end], DIGEST_SEED)] = end - start
        start = end
    return found


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of the smaller fingerprint's length that the other one holds as well."""
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    shared = sum(n for d, n in a.items() if d in b)
    return min(1.0, shared / min(sum(a.values()), sum(b.values())))


def as_text(found: dict[int, int]) -> str:
    """Digests in hexadecimal with lengths, in the order of the digests."""
    return ",".join([f"{d:016x}:{n}" for d, n in sorted(found.items())])


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FIELDS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order; each is finished when the next one of its run is seen, and a run's last row is only looked at."""
    held = None  # (run, doc_id, text, fingerprint, is_tail)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        out = {n: [] for n in names}
        for run, doc_id, text, tail in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            mine = fingerprint(text)
            if held is not None and held[0] == run and not held[4]:
                before, theirs = held[2], held[3]
                changed = edited(before, text)
                new = fingerprint(changed)
                row = (held[1], len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(theirs), as_text(new),
                       containment(theirs, new), containment(theirs, mine))
                for n, v in zip(names, row):
                    out[n].append(v)
            held = (run, doc_id, text, mine, tail)
        yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in zip(names, types)], names=names)


def compare_with_next(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document are.

    The order of ids is cut into runs at ids that are approximate quantiles. A run's last document needs the first one of
    the run after it, so documents at the cuts go to both runs, once as a tail; nothing else is copied. Texts are shuffled
    once, by run, and each run streams through its task.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = runs or 4 * parts
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.agg(F.percentile_approx("doc_id", [k / runs for k in range(1, runs)], 10 * runs).alias("cuts"), F.max("doc_id").alias("top")).first()
    if found.top is None:  # no ids: one run in the order of the texts, closed by its own first row
        cuts, run = [], F.lit(0)
    else:
        cuts = sorted({*found.cuts, found.top})  # run r holds the ids above cut r - 1 up to cut r; rows without an id follow run 0's
        run = F.coalesce(F.size(F.filter(F.lit(cuts), lambda c: c < F.col("doc_id"))), F.lit(0))
    # the first row of run r follows the last one of run r + 1; the first of all follows the last of run 0
    at_cut = F.array_contains(F.lit(cuts), F.col("doc_id")) if cuts else F.lit(True)
    tail_run = F.when(at_cut, (F.col("run") + 1) % max(len(cuts), 1))
    placed = rows.withColumn("run", run).select("doc_id", "text", F.explode(F.array(
        F.struct(F.col("run"), F.lit(False).alias("tail")), F.struct(tail_run.alias("run"), F.lit(True).alias("tail")))).alias("p")).where("p.run IS NOT NULL")
    dealt = placed.select(F.col("p.run").cast("int").alias("run"), "doc_id", "text", F.col("p.tail").alias("tail")).repartition(parts, "run")
    ordered = dealt.sortWithinPartitions("run", "tail", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return ordered.mapInArrow(_compare, FIELDS)
