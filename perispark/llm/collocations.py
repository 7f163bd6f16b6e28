"""Phrase collocations from sorted streams of n-gram counts.

Texts are cut into pieces and words; every run of up to ``ORDER`` words of a piece is counted per language. The counts are kept
as streams, one row per phrase. In prefix order a phrase meets its first words and, behind it, its extensions to the right;
in suffix order it meets its last words and its extensions to the left. Streams are sorted by the words they meet on and merged in
lockstep (sort-merge joins; no hash table is built), which gives left, right and extension counts.

Counting takes two passes over the texts. The first counts runs of two and three words by a hash; a hash counts at least as
often as any of its runs, so a run whose hash stays below ``least`` is no candidate. The second pass counts as text, and
exactly, all words, the runs that are left, and runs of four words whose two runs of three are left. What it needs for
that is a bitmap of fixed size (``FILTER_BITS``): the more frequent runs there are, the more rare ones pass it, but none is
lost. Both passes sum up in the task about a million words at a time before anything is shuffled, so a phrase that fills
a third of all texts is a few rows.

Defined results: a null or empty text has no words; a missing language is ``und``; words are compared byte by byte after A-Z became a-z,
control characters belong to words; repeated rows count again; a language with fewer candidates than asked for returns those it has; equal
scores and counts are ordered by phrase; texts of any length are counted whole, slice by slice; an empty table gives no
rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, find_package

ORDER, LEAST, TOP = 4, 30, 2000
FILTER_BITS = 26  # a bitmap has 2 ** FILTER_BITS bits: 8 MB
HASH_MASK = np.uint64((1 << 40) - 1)  # hashes that are counted have 40 bits
CHUNK_TOKENS, SLICE_BYTES = 1 << 20, 1 << 20
BORDER = b"\xff"  # between pieces; no byte of UTF-8
#: A-Z become a-z, the separators of pieces the border, tabs blanks.
TOKEN_BYTES = bytes(b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
BITMAP_BITS = 32_768  # of one row of bitmap_construct_agg


def slices(text: str | None) -> Iterator[list[bytes]]:
    """Words and borders of a text, about a megabyte at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TOKEN_BYTES)
    at = 0
    while at < len(data):
        end = at + SLICE_BYTES
        if end < len(data):
            stops = [p for p in (data.find(b" ", end), data.find(BORDER, end)) if p >= 0]
            end = min(stops, default=len(data))
        yield data[at:end].replace(BORDER, b" \xff ").split()
        at = end


class Numbers(dict):
    """Words by number, in the order they were met; 0 is the border."""

    def __init__(self):
        super().__init__({BORDER: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Chunk:
    """Tokens of some texts by language, as numbers, until there are enough to count."""

    def __init__(self):
        self.numbers, self.tokens, self.size = Numbers(), {}, 0
        self.carried: dict[str, int] = {}  # tokens at the head that were counted before

    def add(self, lang: str, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words))
        self.tokens.setdefault(lang, []).append(ids)
        self.size += len(ids)

    def end_text(self, lang: str) -> None:
        self.tokens.setdefault(lang, []).append(np.zeros(1, dtype=np.int32))

    def streams(self) -> Iterator[tuple[str, np.ndarray, int]]:
        """Language, its tokens and how many of them were counted before."""
        for lang, parts in self.tokens.items():
            yield lang, np.concatenate(parts), self.carried.get(lang, 0)

    def tail(self, lang: str) -> list[bytes]:
        """The last words of a text that goes on in the next chunk."""
        parts = np.concatenate(self.tokens[lang][-(ORDER + 1):])
        if len(parts) < ORDER - 1:
            parts = np.concatenate(self.tokens[lang])
        names = list(self.numbers)
        return [names[i] for i in parts[-(ORDER - 1):]]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """All texts (columns lang, text) in chunks of about ``CHUNK_TOKENS`` tokens; a text that is cut carries its last words over."""
    chunk = Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            for words in slices(text):
                if chunk.size >= CHUNK_TOKENS:
                    last = chunk.tail(lang) if lang in chunk.tokens else []
                    yield chunk
                    chunk = Chunk()
                    if last:
                        chunk.add(lang, last)
                        chunk.carried[lang] = len(last)
                chunk.add(lang, words)
            chunk.end_text(lang)
    if chunk.size:
        yield chunk


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def mixed(left: np.ndarray, right: np.ndarray, lang: str, seed: int) -> np.ndarray:
    """Hashes of what two hashes stand for, side by side, in a language."""
    import xxhash

    salt = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed))
    found = (left ^ salt) * np.uint64(0x9E3779B97F4A7C15) + right
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


class Bitmap:
    """Membership of hashes in a bitmap of ``2 ** bits`` bits."""

    def __init__(self, data: bytes, bits: int):
        self.data, self.mask = np.frombuffer(data, dtype=np.uint8), np.uint64((1 << bits) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.data[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def runs_of(ids: np.ndarray, hashes: np.ndarray, lang: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(words, places, hashes) of all runs of two to ``ORDER`` - 1 words inside pieces."""
    inside, found = ids != 0, []
    at, run = np.flatnonzero(inside), hashes[ids]
    for n in range(2, ORDER):
        at = at[at + n - 1 < len(ids)]
        at = at[inside[at + n - 1]]
        longer = np.zeros(len(ids), dtype=np.uint64)
        longer[at] = mixed(run[at], hashes[ids[at + n - 1]], lang, n)
        run = longer
        found.append((n, at, run[at]))
    return found


COUNTS = pa.schema([("hash", pa.int64()), ("c", pa.int64())])
COUNTS_SQL = "hash bigint, c bigint"
ROWS = 1 << 16  # of an Arrow batch


def _as_text(words: list[bytes]) -> pa.Array:
    return pa.array(words, type=pa.binary()).cast(pa.string())


def _count_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs by a hash that holds the language too.

    Hashes come in order: neighbours share their leading bytes, and so does what is shuffled.
    """
    for chunk in chunks(batches):
        hashes = word_hashes(list(chunk.numbers))
        for lang, ids, seen in chunk.streams():
            for n, at, run in runs_of(ids, hashes, lang):
                found, times = np.unique(run[at + n - 1 >= seen] & HASH_MASK, return_counts=True)
                for k in range(0, len(found), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(found[k:k + ROWS].astype(np.int64)), pa.array(times[k:k + ROWS])], schema=COUNTS)


PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("c", pa.int64())])
PHRASES_SQL = "lang string, phrase string, words int, c bigint"


def _count_phrases(frequent: Broadcast, bits: int):
    """Exact counts of all words, of the runs of two and three that the bitmap holds, and of those of four made of such.

    A row with 0 words has the number of words of a language.
    """
    def rows(lang: str, texts: pa.Array, parts: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(counts), ROWS):
            some = [texts.take(pa.array(p[k:k + ROWS])) for p in parts]
            n = len(some[0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, type=pa.string()), pc.binary_join_element_wise(*some, " ") if len(some) > 1 else some[0],
                                              pa.array(np.full(n, len(parts), dtype=np.int32)), pa.array(counts[k:k + ROWS])], schema=PHRASES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bitmap(frequent.value, bits)
        for chunk in chunks(batches):
            names = list(chunk.numbers)
            hashes, texts = word_hashes(names), _as_text([b"", *names[1:]])
            for lang, ids, seen in chunk.streams():
                counts = np.bincount(ids[seen:], minlength=len(names))
                counts[0] = 0
                met = np.flatnonzero(counts)
                yield from rows(lang, texts, [met], counts[met])
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([""]), pa.array([0], type=pa.int32()), pa.array([int(counts.sum())])], schema=PHRASES)
                places = {}
                for n, at, found in runs_of(ids, hashes, lang):
                    places[n] = at[held.holds(found)]
                begins = np.zeros(len(ids), dtype=bool)  # of runs of ORDER - 1 words that are left
                begins[places[ORDER - 1]] = True
                at = places[ORDER - 1]
                at = at[at + 1 < len(ids)]
                places[ORDER] = at[begins[at + 1]]
                for n, at in places.items():
                    at = at[at + n - 1 >= seen]  # the others were counted with the tokens before
                    # two words fit into one number; longer runs are two numbers, of their first and last two words
                    first, last = (ids[at].astype(np.int64) << 32) | ids[at + 1], (ids[at + n - 2].astype(np.int64) << 32) | ids[at + n - 1]
                    if n == 2:
                        heads, counts = np.unique(first, return_counts=True)
                        parts = [heads >> 32, heads & 0xFFFFFFFF]
                    else:
                        heads, head = np.unique(first, return_inverse=True)
                        tails, tail = np.unique(last, return_inverse=True)
                        both, counts = np.unique((head << 32) | tail, return_counts=True)
                        first, last = heads[both >> 32], tails[both & 0xFFFFFFFF]
                        parts = [first >> 32, first & 0xFFFFFFFF, *([last >> 32] if n == 4 else []), last & 0xFFFFFFFF]
                    yield from rows(lang, texts, parts, counts)

    return run


def frequent(hashes: DataFrame, bits: int) -> Broadcast:
    """The bitmap of a column ``hash``: 2 ** ``bits`` bits however many there are."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (hashes.select(F.floor(place / BITMAP_BITS).cast("int").alias("block"), (place % BITMAP_BITS).alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())
    whole = bytearray(max(1, (1 << bits) // 8))
    for r in rows:  # at most 2 ** bits / 32,768 rows of 4 KB
        start = r.block * (BITMAP_BITS // 8)
        part = bytes(r.bitmap)[:len(whole) - start]
        whole[start:start + len(part)] = part
    return hashes.sparkSession.sparkContext.broadcast(bytes(whole))


def count_streams(docs: DataFrame, least: int = LEAST, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(phrases of 1 to ``ORDER`` words that occur ``least`` times: lang, phrase, words, f; words of each language: lang, n)."""
    find_package(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    # rows were summed up in the tasks that made them: they are shuffled as they are, and no second table is built there
    parts = 3 * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashes = texts.mapInArrow(_count_hashes, COUNTS_SQL).repartition(parts, "hash").groupBy("hash").agg(F.sum("c").alias("c"))
    held = frequent(hashes.where(F.col("c") >= least).select("hash"), bits)
    exact = texts.mapInArrow(_count_phrases(held, bits), PHRASES_SQL).repartition(parts, "lang", "phrase", "words").groupBy("lang", "phrase", "words").agg(F.sum("c").alias("f"))
    exact = cut_lineage(exact.where((F.col("f") >= least) | (F.col("words") == 0)))
    return exact.where("words > 0"), exact.where("words = 0").select("lang", F.col("f").alias("n"))


def scored(phrases: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its lowest-scoring cut: lang, phrase, words, a, l, r, score."""
    cuts = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    # both joins merge sorted streams: first by the words that lead a phrase, then by those that end it
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    met = cuts.join(heads.hint("merge"), ["lang", "head"]).join(rests.hint("merge"), ["lang", "rest"])
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    return met.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "cut.*")


def kept(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """``candidates`` less those whose words lie in a longer phrase that holds 80 % of their occurrences.

    A phrase of two words more lies in one of one word more that occurs as often or more, so the next longer ones suffice.
    """
    longer = phrases.where("words > 2")
    right = longer.select("lang", F.expr("substring_index(phrase, ' ', words - 1)").alias("inner"), "f")
    left = longer.select("lang", F.expr("substring_index(phrase, ' ', 1 - words)").alias("inner"), "f")
    most = right.unionByName(left).groupBy("lang", "inner").agg(F.max("f").alias("extension"))
    met = candidates.join(most.withColumnRenamed("inner", "phrase").hint("merge"), ["lang", "phrase"], "left")
    covered = F.expr("CAST(100 AS DECIMAL(3,0)) * CAST(extension AS DECIMAL(19,0)) >= CAST(80 AS DECIMAL(3,0)) * CAST(a AS DECIMAL(19,0))")
    return met.where(~F.coalesce(covered, F.lit(False))).drop("extension")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = FILTER_BITS, buckets: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Each of ``buckets`` hash buckets of a language gives its first ``top``, and only those are ranked together.
    """
    phrases, totals = count_streams(docs, least, bits)
    found = kept(scored(phrases), phrases).withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same rows from DuckDB: all runs of words are counted as texts, cuts and longer phrases joined by equality."""
    words = r"regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+')"
    return f"""WITH p AS MATERIALIZED (SELECT coalesce(lang, 'und') AS lang, {words} AS w FROM documents),
 g AS (SELECT lang, k, w[i:i + k - 1] AS ws FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, {ORDER + 1}) r(k) WHERE len(w) >= k)),
 f AS MATERIALIZED (SELECT lang, k, ws, count(*) AS f FROM g GROUP BY lang, k, ws HAVING count(*) >= {least}),
 n AS MATERIALIZED (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
 cuts AS (SELECT c.lang, c.ws, c.f AS a, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score, j
 FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:j] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[j + 1:c.k]),
 best AS MATERIALIZED (SELECT lang, ws, any_value(a) AS a, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r, min(score) AS score FROM cuts GROUP BY lang, ws),
 inner_ AS (SELECT lang, ws[i:i + m - 1] AS ws, max(f) AS most FROM (SELECT lang, ws, f, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, {ORDER}) r(m) WHERE m < k) GROUP BY 1, 2),
 ranked AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.ws, ' ')) AS rank
 FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.ws = b.ws WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a)
 SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
