"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perispark.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (``a``, ``b`` bigint); all nodes of a component have one root.

    In each round every node moves to the one of itself and its neighbours that comes first in a hashed order, and links
    are drawn anew between the places moved to. Hashed order keeps runs of moves short, so chains, stars and dense groups
    all end after a number of rounds that grows with the logarithm of their size. Minima combine before the shuffle, and
    both sides of every join are stored tables, so a node with very many links is split. Rows with a null end or two equal
    ends are no links; an empty table gives an empty one.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return cut_lineage(df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def first(node: str):
        return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("id"))

    edges, moves = tidy(links), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = cut_lineage(both.groupBy("a").agg(F.min(first("b")).alias("m"))
                           .select(F.col("a").alias("node"), F.least(first("a"), F.col("m"))["id"].alias("to")))
        moves.append(move)
        left = edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
        edges = tidy(left.join(move.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b").select(F.col("ta").alias("a"), F.col("tb").alias("b")))
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    at = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        at = at.join(move.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return cut_lineage(at)
