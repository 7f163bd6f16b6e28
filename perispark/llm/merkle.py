"""A Merkle manifest of a dataset by time-forward processing.

Rows become leaves; the leaves of a group, in order, are hashed in runs of ``FAN`` into nodes until one is left, the group's
subroot, and the subroots are hashed the same way into the root. Every node has a label, its last leaf and its level, and
children come before parents in the order of labels. A forward sweep takes nodes from a priority queue in that order: a node
finds the digests of its children at the head of the queue, hashes them, and sends the result on under its parent's label.
The reversed sweep goes through the labels from the root down and sends each child the siblings on its way to the root.

The queue is external: one sweep covers a block of ``FAN ** HEIGHT`` neighbours, which is all that a task holds, and what
leaves a block is stored, dealt to its parent's block and sorted by label for the next sweep. A group of any size is many
blocks, and a table of n rows takes log(n) / log(4096) rounds.

Defined results: rows without an id come first in their group; rows that repeat an id follow in the order of their leaves, and
copies of a whole row are leaves of their own; a null group comes first and is a group; a null id is never tampered with;
texts of any length are hashed whole; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage, find_package
from perispark.operators.ordering import row_positions

FAN, HEIGHT = 16, 3  # children of a node; levels that one sweep covers
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGEST_CHARS = 64


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and its text; ``-`` for null."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.encode(F.concat(*[field(v) for v in values]), "UTF-8"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and the leaf of a tampered text for the ids whose CRC-32 is divisible by 5."""
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    return docs.select(*FIELDS).select("doc_id", "source", leaf([F.col(c) for c in FIELDS]).alias("leaf"),
                                       F.when(tampered, leaf(changed)).alias("changed"))


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``at``, its place from 0 among the rows of its ``group``, and ``n``, their number.

    Rows are dealt to ranges of the order and numbered range by range, so a large group is numbered by many tasks. The
    order must have no nulls.
    """
    ranged = cut_lineage(df.repartitionByRange("group", *order).withColumn("range", F.spark_partition_id()))
    return row_positions(ranged, ["group"], order, F.col("range"), "at", "n").drop("range")


def heights(n: int) -> int:
    """Levels of a sweep over ``n`` nodes of a group."""
    height = 0
    while height < HEIGHT and FAN ** height < n:
        height += 1
    return height


def sweep_up(digests: list[str], height: int) -> tuple[str, list[tuple]]:
    """The digest of a block's top node, and its nodes (last leaf, level, number, digests of the children) by label."""
    if not height:
        return digests[0], []
    last, queue, nodes = len(digests) - 1, [], []

    def send(place: int, level: int, value: str) -> None:
        end = min(last, (place // FAN + 1) * FAN ** (level + 1) - 1)
        heapq.heappush(queue, (end, level + 1, place, value))

    for i, value in enumerate(digests):
        send(i, 0, value)
        while queue and queue[0][0] <= i:
            end, level, place, _ = queue[0]
            children = []
            while queue and queue[0][:2] == (end, level):
                children.append(heapq.heappop(queue)[3])
            nodes.append((end, level, place // FAN, children))
            value = digest(*children)
            if level == height:
                return value, nodes
            send(place // FAN, level, value)
    raise AssertionError("a block ended before its top node")


def sweep_down(nodes: list[tuple], proof: tuple | None) -> list[tuple | None]:
    """The proof of every leaf of a block: (place in its run, the run's other digests, proof of the parent) or None at the root."""
    found: dict[int, tuple] = {}
    last = nodes[-1][0]
    queue = [(-last, -nodes[-1][1], proof)]  # what has been sent to nodes, the last label first
    for end, level, number, children in reversed(nodes):
        above = heapq.heappop(queue)[2]
        whole = "".join(children)
        for k in reversed(range(len(children))):
            others = whole[:k * DIGEST_CHARS] + whole[(k + 1) * DIGEST_CHARS:]
            child, mine = number * FAN + k, (k, others, above)
            if level == 1:
                found[child] = mine
            else:
                heapq.heappush(queue, (-min(last, (child + 1) * FAN ** (level - 1) - 1), 1 - level, mine))
    return [found[i] for i in range(len(found))]


def steps(proof: tuple | None) -> Iterator[tuple[int, str]]:
    """Place and siblings, level by level from the leaf to the root."""
    while proof is not None:
        yield proof[:2]
        proof = proof[2]


def fold(value: str, path: list[tuple[int, str]]) -> str:
    """The root that a digest and its proof lead to."""
    for place, others in path:
        value = digest(others[:place * DIGEST_CHARS], value, others[place * DIGEST_CHARS:])
    return value


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Rows of one block (equal in their first two columns) at a time; rows come sorted."""
    rows = (row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(width)]))
    for _, block in groupby(rows, key=lambda r: r[:2]):
        yield list(block)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)


UP = pa.schema([("group", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
STEP = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
STEP_SQL = "array<struct<place:int,others:string>>"
DOWN = pa.schema([("group", pa.string()), ("at", pa.int64()), ("proof", STEP), ("subroot", pa.string())])
LEAVES = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()),
                    ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("proof", STEP)])
LEAVES_SQL = f"doc_id bigint, source string, leaf string, subroot string, proof_sha256 string, folded_root string, proof {STEP_SQL}"


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tops() -> Iterator[tuple]:
        for block in _blocks(batches, 4):
            group, number, n, _ = block[0]
            yield group, number, -(-n // FAN ** HEIGHT), sweep_up([r[3] for r in block], heights(n))[0]

    yield from _batches(tops(), UP)


def _down(full: bool | None):
    """The reversed sweep; ``full`` is None above the leaves, else whether leaves carry their whole proof."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for block in _blocks(batches, 9):
                (group, _, _, _, _, path, subroot, *_), members = block[0], block[1:]  # what the parent's block has sent comes first
                above = None
                for step in reversed(path):
                    above = (step["place"], step["others"], above)
                digests = [r[4] for r in members]
                _, nodes = sweep_up(digests, heights(members[0][3]))
                proofs = sweep_down(nodes, above) if nodes else [above]
                for member, proof in zip(members, proofs):
                    found = list(steps(proof))
                    listed = [{"place": k, "others": o} for k, o in found] if full is not False else None
                    if full is None:
                        yield group, member[2], listed, subroot
                    else:
                        mine = member[8] if member[8] is not None else member[4]
                        yield member[7], group, member[4], subroot, digest(*[o for _, o in found]), fold(mine, found), listed

        yield from _batches(rows(), DOWN if full is None else LEAVES, 4096 if full is False else 256)

    return run


class Tree:
    """The stored levels of the trees of all groups; each level holds the nodes that one sweep starts from.

    ``rows``: group, at, n, digest, and at will doc_id and changed. ``tops`` has the group, its subroot and the level whose
    sweep ended in it. Levels are a few at any size: each has a 4096th of the rows of the one below.
    """

    def __init__(self, rows: DataFrame):
        self.levels, tops = [cut_lineage(rows)], []
        while True:
            below = self.levels[-1].select("group", F.floor(F.col("at") / FAN ** HEIGHT).cast("bigint").alias("block"), "n", "digest", "at")
            up = below.repartition("group", "block").sortWithinPartitions("group", "block", "at").mapInArrow(_up, "group string, at bigint, n bigint, digest string")
            up = cut_lineage(up)
            tops.append(up.where("n = 1").select("group", F.col("digest").alias("subroot"), F.lit(len(self.levels) - 1).alias("level")))
            more = up.where("n > 1")
            if more.isEmpty():
                break
            self.levels.append(more)
        self.tops = tops[0]
        for some in tops[1:]:
            self.tops = self.tops.unionByName(some)

    def proofs(self, above: DataFrame, full: bool | None) -> DataFrame:
        """Send ``above`` (group, subroot, level, proof from the subroot up) down to all rows of the lowest level."""
        sent = None
        for k in reversed(range(len(self.levels))):
            ended = above.where(F.col("level") == k).select("group", F.lit(0).cast("bigint").alias("at"), "proof", "subroot")
            sent = ended if sent is None else sent.unionByName(ended)
            rows = self.levels[k]
            own = [F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("doc_id", "bigint"), ("changed", "string"))]
            nodes = rows.select("group", F.floor(F.col("at") / FAN ** HEIGHT).cast("bigint").alias("block"), "at", "n", "digest",
                                F.lit(None).cast(STEP_SQL).alias("proof"), F.lit(None).cast("string").alias("subroot"), *own)
            heads = sent.select("group", F.col("at").alias("block"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("n"),
                                F.lit("").alias("digest"), "proof", "subroot", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("changed"))
            dealt = nodes.unionByName(heads).repartition("group", "block").sortWithinPartitions("group", "block", "at")
            if k:
                sent = cut_lineage(dealt.mapInArrow(_down(None), f"group string, at bigint, proof {STEP_SQL}, subroot string"))
        return dealt.mapInArrow(_down(full), LEAVES_SQL) if full is not None else dealt.mapInArrow(_down(None), f"group string, at bigint, proof {STEP_SQL}, subroot string")


def manifest(docs: DataFrame, full: bool = False) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``folded_root`` is worked out from the tampered leaf, where there is one, and the original siblings. With ``full`` each row
    also has its proof: place and siblings level by level.
    """
    find_package(docs.sparkSession)
    # the number tells copies of a whole row apart; it is stored before anything is ordered by it
    named = cut_lineage(leaves(docs).withColumn("copy", F.monotonically_increasing_id()))
    keyed = named.select(F.col("source").alias("group"), F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                         F.col("leaf").alias("digest"), "copy", "doc_id", "changed")
    rows = in_order(keyed, ["known", "id", "digest", "copy"]).select("group", "at", "n", "digest", "doc_id", "changed")
    groups = Tree(rows)
    listed = groups.tops.select(F.lit("").alias("group"), F.col("group").isNotNull().alias("known"), F.coalesce("group", F.lit("")).alias("name"),
                                F.col("subroot").alias("digest"), F.col("group").alias("of"), F.col("level").alias("of_level"))
    placed = cut_lineage(in_order(listed, ["known", "name"]))
    upper = Tree(placed.select("group", "at", "n", "digest"))
    root = upper.tops.select(F.col("subroot").alias("root")).first()
    top = upper.tops.select("group", "subroot", "level", F.array().cast(STEP_SQL).alias("proof"))
    sent = cut_lineage(upper.proofs(top, None))
    above = placed.join(sent.select(F.col("at").alias("place"), "proof"), F.col("at") == F.col("place")).select(
        F.col("of").alias("group"), F.col("digest").alias("subroot"), F.col("of_level").alias("level"), "proof")
    found = groups.proofs(cut_lineage(above), full).withColumn("root", F.lit(root.root if root else None).cast("string"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop(*([] if full else ["proof"]))


def report(docs: DataFrame) -> DataFrame:
    return manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _levels_sql(name: str, source: str, group: str, depth: int) -> str:
    """``name``0 to ``name``<depth>: group, pos, n, digest, run (the digests of the node's run) of every node."""
    run = f"string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY {group}, pos // {FAN} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    parts = [f"{name}0 AS MATERIALIZED (SELECT {group}, pos, n, digest, {run} AS run FROM {source})"]
    for k in range(depth):
        once = f"SELECT {group}, pos // {FAN} AS pos, (any_value(n) + {FAN - 1}) // {FAN} AS n, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(any_value(run)) END AS digest FROM {name}{k} GROUP BY {group}, pos // {FAN}"
        parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {group}, pos, n, digest, {run} AS run FROM ({once}))")
    return ",\n ".join(parts)


def _walk_sql(name: str, before: str, group: str, depth: int, place: str) -> tuple[str, str]:
    """Steps that follow rows of ``before`` (with group, ``place``, proof, folded) up the levels of ``name``."""
    parts = []
    for k in range(depth):
        c = DIGEST_CHARS
        at = f"(w.{place} // {FAN ** k})"
        left, right = f"substr(l.run, 1, {c} * ({at} % {FAN}))", f"substr(l.run, {c} * ({at} % {FAN} + 1) + 1)"
        parts.append(f"{name}_walk{k} AS MATERIALIZED (SELECT w.* REPLACE (CASE WHEN l.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,"
                     f" CASE WHEN l.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded) FROM {before} w JOIN {name}{k} l"
                     f" ON w.{group} IS NOT DISTINCT FROM l.{group} AND {at} = l.pos)")
        before = f"{name}_walk{k}"
    return ",\n ".join(parts), before


def oracle_sql(depth: int = 7) -> str:
    """The same rows from DuckDB, up to ``FAN ** depth`` rows of a group; an id that repeats counts once a row."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    whole = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    crc = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(unicode(ch) AS BIGINT))),"
           " lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)")
    walk, after = _walk_sql("s", "started", "source", depth, "pos")
    top, last = _walk_sql("r", "risen", "one", depth, "place")
    return f"""WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
 hashed AS MATERIALIZED (SELECT doc_id, source, {whole("text")} AS digest, CASE WHEN {crc} % 5 = 0 THEN {whole(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed FROM documents, t),
 leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM hashed),
 {_levels_sql("s", "leaves", "source", depth)},
 subroots AS MATERIALIZED (SELECT 1 AS one, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM s{depth}),
 {_levels_sql("r", "subroots", "one", depth)},
 started AS (SELECT *, '' AS proof, coalesce(changed, digest) AS folded FROM leaves),
 {walk},
 risen AS MATERIALIZED (SELECT w.*, 1 AS one, b.digest AS subroot, b.pos AS place FROM {after} w JOIN subroots b ON w.source IS NOT DISTINCT FROM b.source),
 {top}
 SELECT doc_id, w.digest AS leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified FROM {last} w, r{depth} r"""
