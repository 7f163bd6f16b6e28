"""Placement of documents by descending a weighted hash tree: region, rack, shard.

At each level every child draws -ln(u) / weight, u being a hash of the document's id and the child's name, and the
smallest draw wins (a weighted rendezvous). A child's weight is the sum of its shards' weights. A draw depends on nothing
but the id, the child and the child's weight, so when weights change, rows move only into a subtree that gained weight or
out of one that lost weight; below a subtree whose weights are as before, all rows stay where they are. A further shard is
hung up as a region of its own, so it takes rows only into itself.

The law is ``key``: the id and the number of shards decide. Defined results: a null text has size 16 and the CRC-32 of the
empty text; a null id draws as the empty string; rows that repeat an id share its shard and have slots of their own; an
empty table stays empty; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BASE_SHARDS, RACK_SHARDS, REGION_RACKS = 40, 5, 2
ROW_BYTES = 16


@dataclass(frozen=True)
class Node:
    """A part of the tree; ``shard`` is set on leaves."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def parent(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(shards: int, weights: dict[int, float] | None = None, base: int = BASE_SHARDS) -> Node:
    """The tree of shards 0 to ``shards`` - 1: the first ``base`` in racks and regions, each further one in its own."""
    weights = weights or {}
    leaf = lambda s: Node(f"s{s}", weights.get(s, 1.0), shard=s)
    regions = []
    size = RACK_SHARDS * REGION_RACKS
    for r in range(0, min(shards, base), size):
        racks = [parent(f"k{k // RACK_SHARDS}", [leaf(s) for s in range(k, min(k + RACK_SHARDS, shards, base))])
                 for k in range(r, min(r + size, shards, base), RACK_SHARDS)]
        regions.append(parent(f"r{r // size}", racks))
    regions += [parent(f"x{s}", [parent(f"y{s}", [leaf(s)])]) for s in range(base, shards)]
    return parent("root", regions)


def choices(nodes: list[Node], numbers: list[int]) -> Column:
    """A constant list of the nodes that can be drawn (those with weight): name, weight, number."""
    return F.array(*[F.struct(F.lit(n.name).alias("name"), F.lit(float(n.weight)).alias("weight"), F.lit(i).alias("number"))
                     for n, i in zip(nodes, numbers) if n.weight > 0])


def choose(key: Column, among: Column) -> Column:
    """Number of the node with the smallest weighted draw for a key; ties go to the smaller number.

    A draw is exponential with the weight as rate, from 52 bits of the MD5 of the node's name and the key.
    """
    def draw(node: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.encode(F.concat(node["name"], F.lit(":"), key), "UTF-8")), 1, 13), 16, 10).cast("double")
        return F.struct((-F.log((bits + 0.5) / float(1 << 52)) / node["weight"]).alias("draw"), node["number"].alias("number"))

    return F.array_min(F.transform(among, draw))["number"]


def place(docs: DataFrame, key: Column, root: Node, out: str) -> DataFrame:
    """``docs`` with the shard of ``key`` under ``root``: one step per level, each drawing only among the children reached."""
    region, rack = f"{out}_region", f"{out}_rack"
    regions = list(root.children)
    racks = [k for r in regions for k in r.children]
    at = {k.name: i for i, k in enumerate(racks)}
    racks_of = F.array(*[choices(list(r.children), [at[k.name] for k in r.children]) for r in regions])
    shards_of = F.array(*[choices(list(k.children), [s.shard for s in k.children]) for k in racks])
    return (docs.withColumn(region, choose(key, choices(regions, list(range(len(regions))))))
            .withColumn(rack, choose(key, F.element_at(racks_of, F.col(region) + 1)))
            .withColumn(out, choose(key, F.element_at(shards_of, F.col(rack) + 1)).cast("int")).drop(region, rack))


def assign(docs: DataFrame, shards: int = BASE_SHARDS, weights: dict[int, float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard of weight 1) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = place(place(rows, key, tree(shards, weights), "shard"), key, tree(shards + 1, weights), "grown_shard")
    # slots: numbered in 256 hash buckets of each shard, so that a shard's rows are spread over many tasks; the text's
    # CRC-32 spreads rows that share an id or have none
    rows = rows.withColumn("_bucket", F.substring(F.md5(F.encode(F.concat_ws(":", key, "text_crc32"), "UTF-8")), 1, 2))
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).drop("_n")
    numbered = rows.withColumn("_in", F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")) - 1)
    return numbered.join(before, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_before") + F.col("_in")).cast("bigint").alias("slot"), "grown_shard")


def _tree_sql(name: str, root: Node) -> str:
    """Common table expressions that descend ``root`` for the rows of ``keyed`` (rid, key), as ``name`` (rid, shard)."""
    regions, racks = list(root.children), [k for r in root.children for k in r.children]
    at = {k.name: i for i, k in enumerate(racks)}
    levels = {
        "region": [(0, r, i) for i, r in enumerate(regions)],
        "rack": [(i, k, at[k.name]) for i, r in enumerate(regions) for k in r.children],
        "shard": [(at[k.name], s, s.shard) for k in racks for s in k.children],
    }
    parts, before = [], "(SELECT rid, key, 0 AS place FROM keyed)"
    for level, nodes in levels.items():
        values = ", ".join(f"({up}, '{n.name}', {float(n.weight)!r}::DOUBLE, {i})" for up, n, i in nodes if n.weight > 0)
        draw = "-ln((CAST('0x' || substr(md5(n.name || ':' || p.key), 1, 13) AS BIGINT) + 0.5) / 4503599627370496) / n.weight"
        parts.append(f"{name}_{level} AS MATERIALIZED (SELECT rid, any_value(key) AS key, arg_min(number, (draw, number)) AS place FROM (SELECT p.rid, p.key, n.number, {draw} AS draw"
                     f" FROM {before} p JOIN (VALUES {values}) n(above, name, weight, number) ON p.place = n.above) GROUP BY rid)")
        before = f"{name}_{level}"
    return ",\n ".join(parts)


def oracle_sql(shards: int = BASE_SHARDS) -> str:
    """The same rows from DuckDB; the CRC-32 is folded byte by byte over a table that is built bit by bit."""
    u = "unicode(ch)"
    utf8 = (f"CASE WHEN text = '' THEN CAST([] AS BIGINT[]) WHEN {u} < 128 THEN [CAST({u} AS BIGINT)] WHEN {u} < 2048 THEN [192 + ({u} >> 6), 128 + ({u} & 63)]"
            f" WHEN {u} < 65536 THEN [224 + ({u} >> 12), 128 + (({u} >> 6) & 63), 128 + ({u} & 63)]"
            f" ELSE [240 + ({u} >> 18), 128 + (({u} >> 12) & 63), 128 + (({u} >> 6) & 63), 128 + ({u} & 63)] END")
    return f"""WITH t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
 keyed AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents),
 bytes AS (SELECT rid, doc_id, key, strlen(text) + 16 AS size, flatten(list_transform(string_split(text, ''), lambda ch: {utf8})) AS bytes FROM keyed),
 {_tree_sql("now", tree(shards))},
 {_tree_sql("grown", tree(shards + 1))},
 sized AS (SELECT rid, doc_id, key, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM bytes, t)
 SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(n.place AS INTEGER) AS shard,
 row_number() OVER (PARTITION BY n.place ORDER BY substr(md5(s.key || ':' || CAST(text_crc32 AS VARCHAR)), 1, 2), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(g.place AS INTEGER) AS grown_shard
 FROM sized s JOIN now_shard n USING (rid) JOIN grown_shard g USING (rid)"""
