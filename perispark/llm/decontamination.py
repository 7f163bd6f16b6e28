"""Benchmark decontamination with an Aho-Corasick automaton.

Texts become sequences of lower-case words. Every run of ``width`` words of a benchmark item is a window; an item with fewer
words is one window. One automaton over all windows reads each document's words once and reports every window in it, however
windows overlap. Hits are runs of words; they are mapped back to offsets (code points) in the original text.

The automaton works on word numbers, not on letters, and holds at most about ``block_windows`` pairs of window and item: a
worker's memory does not grow with the benchmark. A larger benchmark is dealt to blocks by hash, each block reads all
documents, and only the hits of further blocks are joined to the documents.

Defined results: a null or empty text, or one without words, has no words and no hits; an item without words has no windows; an
item without an id marks words but is not counted; items that repeat an id are one item; documents that repeat an id, and copies of rows,
are reported row by row; an empty benchmark finds nothing; an empty table gives no rows; extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, find_package, map_columns

WIDTH = 10
BLOCK_WINDOWS = 200_000
#: Words are runs of digits, letters and everything beyond ASCII: each other byte becomes a blank, A-Z becomes a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def lower_words(text: str | None) -> bytes:
    """The text's UTF-8 bytes with blanks for all that is no word; offsets stay as they are."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)


def item_windows(text: str | None, width: int = WIDTH) -> list[str]:
    """Distinct windows of an item, words joined by blanks."""
    words = lower_words(text).decode("utf-8", "surrogatepass").split(" ")
    words = [w for w in words if w]
    if not words:
        return []
    return list(dict.fromkeys(" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))))


class Matcher:
    """The automaton of one block: words by number, and the items of each window."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        import ahocorasick

        class Numbers(dict):
            def __missing__(self, word: bytes) -> int:
                return 0  # a word of no window

        self.numbers, self.items, self.lengths = Numbers(), [], []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for i, (window, items) in enumerate(windows):
            words = window.encode("utf-8", "surrogatepass").split(b" ")
            self.automaton.add_word(tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]), i)
            self.items.append(items)
            self.lengths.append(len(words))
        self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """(first, last) of the merged runs of hit words, and the items found."""
        if not self.items or not words:
            return [], []
        runs, seen = [], set()
        for end, i in self.automaton.iter(tuple(map(self.numbers.__getitem__, words))):
            seen.add(i)
            first = end - self.lengths[i] + 1
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first - 1:
                runs[-1] = (runs[-1][0], end)
            else:
                runs.append((first, end))
        return runs, sorted({x for i in seen for x in self.items[i]})


def spans_of(text: str, normal: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Word runs with their offsets in the original text, in code points."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.concatenate([[False], np.frombuffer(normal, dtype=np.uint8) != 32, [False]])
    starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    found, at, chars = [], 0, 0
    for first, last in runs:
        start, end = int(starts[first]), int(ends[last])
        chars += int(np.count_nonzero((data[at:start] & 0xC0) != 0x80))
        length = int(np.count_nonzero((data[start:end] & 0xC0) != 0x80))
        found.append({"first": first, "last": last, "start": chars, "end": chars + length})
        at, chars = end, chars + length
    return found


_loaded: dict = {}  # the block that a worker process last used, and its automaton


def _matcher(block: Broadcast) -> Matcher:
    if _loaded.get("windows") is not block.value:
        _loaded.update(windows=block.value, matcher=Matcher(block.value))
    return _loaded["matcher"]


HITS = "n_words bigint, spans array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>, items array<string>"


def _scan(docs: DataFrame, block: Broadcast) -> DataFrame:
    def run(texts: list) -> dict:
        matcher, out = _matcher(block), {"n_words": [], "spans": [], "items": []}
        for text in texts:
            normal = lower_words(text)
            words = normal.split()
            runs, items = matcher.find(words)
            out["n_words"].append(len(words))
            out["spans"].append(spans_of(text, normal, runs) if runs else [])
            out["items"].append(items)
        return out

    return map_columns(docs, ["text"], HITS, run, keep=[c for c in docs.columns if c != "text"])


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct pairs of window and item (as text, null without an id)."""
    rows = map_columns(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"), ["text"], "windows array<string>",
                       lambda texts: {"windows": [item_windows(t, width) for t in texts]}, keep=["item"])
    return rows.select("item", F.explode("windows").alias("window")).distinct()


def _blocks(spark: SparkSession, benchmark: DataFrame, width: int, block_windows: int) -> list[Broadcast]:
    """The windows in blocks of about ``block_windows`` pairs; each is the only thing the driver holds of the benchmark."""
    pairs = cut_lineage(windows_of(benchmark, width))
    count = max(1, -(-pairs.count() // block_windows))
    found = []
    for b in range(count):
        windows = defaultdict(list)
        for r in pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(count)) == b).collect():
            windows[r.window] += [r.item] if r.item is not None else []
        found.append(spark.sparkContext.broadcast(sorted(windows.items())))
    return found


def merged(spans: list[dict]) -> list[dict]:
    """Runs of words with those that overlap or touch made one."""
    found: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if found and s["first"] <= found[-1]["last"] + 1:
            if s["last"] > found[-1]["last"]:
                found[-1] = found[-1] | {"last": s["last"], "end": s["end"]}
        else:
            found.append(dict(s))
    return found


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, spans (hit runs: numbers of the first and last word, start and end in the text) and items of every document."""
    spark = docs.sparkSession
    find_package(spark)
    first, *rest = _blocks(spark, benchmark, width, block_windows)
    if not rest:
        return _scan(docs.select("doc_id", "text"), first)
    # equal rows have equal hits, so the id and the text's digest are key enough
    keyed = docs.select("doc_id", "text", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("digest"))
    more = None
    for block in rest:
        some = _scan(keyed, block).where(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"])
        more = some if more is None else more.unionByName(some)
    more = more.groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    rows = _scan(keyed, first)
    both = rows.join(more.withColumnsRenamed({"doc_id": "other_id", "digest": "other_digest"}),
                     F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("digest") == F.col("other_digest")), "left")
    joined = both.select("doc_id", "n_words", F.concat("spans", F.coalesce("more_spans", F.array())).alias("all_spans"),
                         F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", F.array())))).alias("items"))
    spans = HITS.split(", ")[1]
    return map_columns(joined, ["all_spans"], spans, lambda found: {"spans": [merged(s) for s in found]}, keep=["doc_id", "n_words", "items"]).select("doc_id", "n_words", "spans", "items")


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; and the spans."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"] + 1)
    return scan(docs, benchmark, width, block_windows).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.concat_ws(",", "items"), "UTF-8"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def oracle_sql(width: int = WIDTH) -> str:
    """The same rows from DuckDB: windows as texts, joined by equality for each length of a window."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
 i AS MATERIALIZED (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
 iw AS MATERIALIZED (SELECT DISTINCT item, least(len(w), {width}) AS k, array_to_string(w[p:p + least(len(w), {width}) - 1], ' ') AS win
 FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {width - 1}) + 1)) AS p FROM i WHERE len(w) > 0)),
 dw AS (SELECT rid, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM (
 SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
 hits AS MATERIALIZED (SELECT rid, p, k, item FROM dw JOIN iw USING (k, win)),
 marked AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(p, p + k)) AS pos FROM hits) GROUP BY rid),
 named AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
 SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN marked USING (rid) LEFT JOIN named USING (rid)"""
