"""Secret scans: patterns that stand for themselves, and multipart credentials linked across a text.

The base kinds (assignments, access identifiers, hexadecimal keys) are reported wherever they occur. Weak candidates, a
login name, a short or loosely written password, an endpoint, are reported only when their complements are near: each
part lies in a bin of its text, and an interval join with the neighbouring bins' summaries tells whether a complement
ends or starts within ``SCOPE_CHARS``. A bin is one row per kind, so a text with very many candidates costs no pairs.

Rules: a weak secret needs an identifier (weak or base) or an endpoint in scope; a weak identifier needs a secret (weak,
assignment or hexadecimal key); an endpoint needs both an identifier and a secret.

Defined results: null text counts as empty and has no spans; rows that repeat an id and a text have the same spans;
positions count code points, ends are exclusive; texts of any length are scanned whole, in time that grows with their
length and matches; an empty table stays empty; columns of other names stay, whatever they are called. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, fresh

SCOPE_CHARS = 256
#: kind -> (pattern, group that must have the least length, least length); the order breaks ties of the start.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
WEAK = {
    "ident": (r"""(?i)(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]+""", 0, 6),
    "weak": (r"""(?i)(?<![a-z_])(?:pass|pwd|passphrase|key|auth|credentials?)["']?\x20*[:=]\x20*["']?[^\s"',;]+""", 0, 8),
    "endpoint": (r"""(?i)(?:(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]+)""", 0, 8),
}
KINDS = [*BASE, *WEAK]
#: What each weak kind needs within scope: all of the sets, one member of each.
NEEDS = {"ident": [("assign", "hex", "weak")], "weak": [("ident", "access", "endpoint")], "endpoint": [("ident", "access"), ("assign", "hex", "weak")]}
SPAN = "struct<start:int,rank:int,end:int,kind:string>"


SLICE = 256  # appending to an array copies it: long walks go slice by slice


def in_slices(rows: Column, start: Column, step, kind: str, tail=None) -> Column:
    """Walk ``rows`` with ``step`` (accumulator ``at``, ``found``; row) and return all of ``found``, an array of ``kind``.

    Each slice of ``SLICE`` rows fills an array of its own, so the work grows with the number of rows and not with its square.
    ``tail`` makes one last element of the final accumulator.
    """
    empty = F.array().cast(f"array<{kind}>")
    parts = F.array().cast(f"array<array<{kind}>>")

    def over(bound: Column) -> Column:
        def one(acc: Column, i: Column) -> Column:
            inner = F.aggregate(F.slice(bound, i * SLICE + 1, F.lit(SLICE)), F.struct(acc["at"].alias("at"), empty.alias("found")), step)
            return F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["parts"], x["found"]).alias("parts")))[0]

        numbers = F.sequence(F.lit(0), F.floor(F.size(bound) / SLICE).cast("int"))
        done = (lambda acc: F.flatten(acc["parts"])) if tail is None else (lambda acc: F.array_append(F.flatten(acc["parts"]), tail(acc["at"])))
        return F.aggregate(numbers, F.struct(start.alias("at"), parts.alias("parts")), one, done)

    return F.transform(F.array(rows), over)[0]  # a bound name: the rows are made once


def spans(text: Column, kind: str) -> Column:
    """Spans of a kind in a text: starts follow from the lengths of what lies between the matches and of the matches.

    All leftmost matches are walked; those below the kind's least length are left out afterwards.
    """
    pattern, group, least = (BASE | WEAK)[kind]
    if kind == "hex":  # a run of 32 or more is found whole either way
        pattern, least = r"[0-9a-f]{32,}", 0
    elif kind == "access":
        pattern, least = r"AKIA[A-Z0-9]{12,}", 0
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    between = F.split(text, pattern, -1)
    rows = F.transform(F.arrays_zip(between.alias("gap"), matches.alias("match"), judged.alias("judged")),
                       lambda r: F.struct(F.length(r["gap"]).alias("gap"), F.length(r["match"]).alias("match"), F.length(r["judged"]).alias("judged")))

    def step(acc: Column, r: Column) -> Column:
        start = acc["at"] + r["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + r["match"]).alias("end"), F.lit(kind).alias("kind"))
        return F.struct((start + r["match"]).alias("at"), F.when(r["judged"] >= least, F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    none = F.lit(None).cast(f"array<{SPAN}>")
    walked = in_slices(F.slice(rows, 1, F.size(matches)), F.lit(0), step, SPAN)
    return F.coalesce(F.when(text.rlike(pattern), walked), none)


def candidates(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """``docs`` with an array of all spans, strong and weak, in order of their start."""
    whole = F.coalesce(F.col(text), F.lit(""))
    empty = F.array().cast(f"array<{SPAN}>")
    return docs.withColumn(out, F.array_sort(F.concat(*[F.coalesce(spans(whole, k), empty) for k in KINDS])))


def linked(found: DataFrame) -> DataFrame:
    """Weak spans with all complements in scope. ``found``: key, start, rank, end, kind, one row per span.

    A complement is in scope if fewer than ``SCOPE_CHARS`` characters lie between it and the span, or they overlap. Bins
    are as wide as the scope: what touches a bin of the span is in scope; of the bin before only the last end counts, of
    the bin after only the first start.
    """
    low = F.floor(F.col("start") / SCOPE_CHARS).cast("int")
    high = F.floor((F.col("end") - 1) / SCOPE_CHARS).cast("int")
    touched = found.withColumn("bin", F.explode(F.sequence(low, high)))
    sums = cut_lineage(touched.groupBy("key", "bin").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("start"))).alias(f"first_{k}") for k in KINDS],
        *[F.max(F.when(F.col("kind") == k, F.col("end"))).alias(f"last_{k}") for k in KINDS]))
    weak = found.where(F.col("kind").isin(*WEAK)).withColumn("low", low).withColumn("high", high)
    near = weak.withColumn("bin", F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1))).join(sums, ["key", "bin"])

    def close(kind: str) -> Column:
        first, last = F.col(f"first_{kind}"), F.col(f"last_{kind}")
        return (F.when(F.col("bin") < F.col("low"), last > F.col("start") - SCOPE_CHARS)
                .when(F.col("bin") > F.col("high"), first < F.col("end") + SCOPE_CHARS).otherwise(first.isNotNull()))

    met = near.groupBy("key", "start", "rank", "end", "kind").agg(*[F.max(F.coalesce(close(k), F.lit(False))).alias(k) for k in KINDS])
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        every = F.col("kind") == kind
        for options in needs:
            every = every & F.greatest(*[F.col(k) for k in options])
        enough = enough | every
    return met.where(enough).select("key", "start", "rank", "end", "kind")


def scan(docs: DataFrame, out: str = "spans", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with an array of reported spans (start, rank, end, kind), base kinds and linked weak ones, by start.

    Without ``keep_text`` the text is dropped, and the spans are stored once instead of being looked for twice.
    """
    every, key, weak = fresh(docs, "_every", "_key", "_weak")
    found = candidates(docs, every, text).withColumn(key, F.xxhash64("doc_id", text))
    if not keep_text:
        found = cut_lineage(found.drop(text))
    some = found.where(F.exists(every, lambda s: s["rank"] >= len(BASE)))
    exploded = cut_lineage(some.select(F.col(key).alias("key"), F.explode(every).alias("s")).select("key", "s.*").distinct())
    links = linked(exploded).groupBy("key").agg(F.collect_set(F.struct("start", "rank", "end", "kind")).alias(weak))
    joined = found.join(links.withColumnRenamed("key", key), key, "left")
    strong = F.filter(every, lambda s: s["rank"] < len(BASE))
    # a set of one text's spans; a key shared by two texts (a hash collision) is undone by keeping only spans of this text
    reported = F.array_sort(F.concat(strong, F.array_intersect(F.coalesce(F.col(weak), F.array().cast(f"array<{SPAN}>")), F.col(every))))
    return joined.withColumn(out, reported).drop(every, key, weak)


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    rows = scan(docs.select("doc_id", "text"), keep_text=False)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every reported span's characters replaced by one mark; overlapping spans share it. n_chars follows."""
    found = fresh(docs, "_spans")[0]
    rows = scan(docs, found)
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["found"]).otherwise(F.concat(acc["found"], F.array(
                F.struct(acc["at"].alias("from"), s["start"].alias("to"))))).alias("found")))

    # what stays: the stretches between marks, and the rest; cut out of the text once each
    gaps = in_slices(F.col(found), F.lit(0), step, "struct<from:int,to:int>", lambda at: F.struct(at.alias("from"), F.length(text).alias("to")))


    def over(bound: Column) -> Column:
        """Stretches are cut out of a slice's part of the text, not each out of the whole: finding a place takes time that grows with it."""
        def part(i: Column) -> Column:
            some = F.slice(bound, i * SLICE + 1, F.lit(SLICE))
            low, high = F.get(some, F.lit(0))["from"], F.element_at(some, -1)["to"]
            piece = F.struct(some.alias("gaps"), low.alias("low"), F.substring(text, low + 1, high - low).alias("text"))
            return F.transform(F.array(piece), lambda p: F.array_join(
                F.transform(p["gaps"], lambda g: F.substring(p["text"], g["from"] - p["low"] + 1, g["to"] - g["from"])), mark))[0]

        return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(bound) - 1) / SLICE).cast("int")), part), mark)

    clean = F.transform(F.array(gaps), over)[0]
    rows = rows.withColumn("text", F.when(F.size(found) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
