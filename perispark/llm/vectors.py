"""Near-duplicate vectors by product quantisation with coarse inverted lists.

A coarse codebook and, for the residuals, one codebook per subspace are fitted on a bounded sample of vectors; every
vector is then indexed. It lies in the list of its nearest centroid, and it also visits each list whose border (the plane
halfway between the two centroids) is within half the step that a link of the given cosine makes. The two vectors of a link lie
on two sides of the border, and their distances to it add up to the step at most, so one of them visits the other: no link
is missed, whatever its direction. Where both visit, the link counts in the list of the lower number. In a list, distances
come from a table of squared subspace distances per query (asymmetric). A candidate is dropped only where its table
distance exceeds the link distance plus the stored quantisation error, which loses nothing; the rest is compared exactly
in double precision.

Equal vectors of a label are one node with a weight, so copies are never compared. Lists with many members are cut into
blocks, and each pair of blocks is a task of its own that returns one row per linked node, not per pair.

Defined results: vectors that are null, all zero, or hold null or non-finite components, and vectors without a label, link
with nothing and are components of their own; vectors of different lengths do not link; repeated rows are vectors of their
own; a row without vec_id counts as a vector, and its component is named by the smallest id in it, or null.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perispark.llm.common import cut_lineage
from perispark.llm.graph import components

SAMPLE_ROWS = 16_384  # bound of the vectors that codebooks are fitted on
LIST_ROWS, MOST_LISTS = 1_024, 1_024  # vectors a list is meant to hold over all labels; bound of the lists
SUBSPACES, CODES = 8, 64
BLOCK = 4_096  # members of a list compared in one task


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """``k`` centroids of the rows of ``points`` (fewer if there are fewer rows); an empty cluster keeps its centroid."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), size=min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)[0]
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each point, and all squared distances."""
    far = (points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :]
    return far.argmin(1), far


class Codebooks:
    """Coarse centroids and residual subspace codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 7):
        self.coarse = kmeans(sample, lists, seed)
        home = nearest(sample, self.coarse)[0]
        residual = sample - self.coarse[home]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [kmeans(residual[:, cut], CODES, seed + 1 + m) for m, cut in enumerate(self.cuts)]

    def encode(self, points: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Home list, lists to visit (borders within ``reach``), residual codes and quantisation error of each point."""
        home, far = nearest(points, self.coarse)
        gap = far - far[np.arange(len(points)), home][:, None]
        between = np.sqrt(np.maximum((self.coarse ** 2).sum(1)[home][:, None] - 2 * self.coarse[home] @ self.coarse.T + (self.coarse ** 2).sum(1)[None, :], 0))
        close = (gap <= 2 * reach * between + 1e-9) & (np.arange(len(self.coarse))[None, :] != home[:, None])
        residual = points - self.coarse[home]
        codes = np.stack([nearest(residual[:, cut], book)[0] for cut, book in zip(self.cuts, self.books)], axis=1).astype(np.uint8)
        error = np.sqrt(sum(((residual[:, cut] - book[codes[:, m]]) ** 2).sum(1) for m, (cut, book) in enumerate(zip(self.cuts, self.books))))
        return home, [np.flatnonzero(row) for row in close], codes, error

    def table_distance(self, queries: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Distance of each query to each coded member of list ``home``: one table look-up per subspace."""
        residual, total = queries - self.coarse[home], np.zeros((len(queries), len(codes)), dtype=np.float32)
        for m, (cut, book) in enumerate(zip(self.cuts, self.books)):
            total += nearest(residual[:, cut], book)[1].astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def unit(rows) -> np.ndarray:
    points = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    largest = np.abs(points).max(axis=1, keepdims=True)  # first by the largest part, so that no square overflows or vanishes
    points = points / largest
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``node``, ``label``, ``embedding``, ``weight``, ``first_id``: usable vectors, equal ones of a label as one."""
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
              & F.exists("embedding", lambda x: x != 0))
    found = rows.where(usable).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"))
    return cut_lineage(found.withColumn("node", F.monotonically_increasing_id()))  # stored, so numbers stay as they are


def fit_codebooks(nodes: DataFrame) -> dict[int, Codebooks]:
    """Codebooks per vector length, from the first ``SAMPLE_ROWS`` vectors in hashed order."""
    found = {}
    for size in nodes.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect():
        some = nodes.where(F.size("embedding") == size.d).orderBy(F.xxhash64("embedding", "label")).limit(SAMPLE_ROWS).select("embedding").collect()
        found[size.d] = Codebooks(unit([r.embedding for r in some]), max(1, min(MOST_LISTS, size.n // LIST_ROWS)))
    return found


def index(nodes: DataFrame, books: dict[int, Codebooks], threshold: float) -> DataFrame:
    """Every node with its list (numbered within its length), the lists it visits, its codes and its error."""
    step = math.sqrt(2 - 2 * threshold)

    def run(frames):
        for frame in frames:
            for d, part in frame.groupby(frame["embedding"].map(len)):
                home, visits, codes, error = books[d].encode(unit(part["embedding"]), step / 2 + 1e-6)
                yield pd.DataFrame({"node": part["node"], "label": part["label"], "d": d, "embedding": part["embedding"], "weight": part["weight"],
                                    "home": home, "visits": visits, "codes": [c.tobytes() for c in codes], "error": error})

    schema = T.StructType([nodes.schema["node"], nodes.schema["label"], T.StructField("d", T.IntegerType()), nodes.schema["embedding"], nodes.schema["weight"]]
                          + list(T.StructType.fromDDL("home int, visits array<int>, codes binary, error double")))
    return cut_lineage(nodes.select("node", "label", "embedding", "weight").mapInPandas(run, schema))


def compare(books: dict[int, Codebooks], threshold: float):
    """Links of one pair of blocks: per linked node the weight it is linked to, and a node of its part of the group."""
    step = math.sqrt(2 - 2 * threshold)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        d, home = int(key[1]), int(key[2])
        group = group.sort_values(["role", "node"], kind="stable").reset_index(drop=True)
        points, role, n = unit(group["embedding"]), group["role"].to_numpy(), len(group)
        members, queries = np.flatnonzero((role == "b") | (role == "e")), np.flatnonzero(role != "e")
        weight, linked, part = group["weight"].to_numpy(), np.zeros(n, dtype=np.int64), np.arange(n)
        codes = np.array([np.frombuffer(c, dtype=np.uint8) for c in group["codes"].iloc[members]]).reshape(len(members), -1)
        error = group["error"].to_numpy()[members]
        # visitors' own lists, and which members visit those: such a link counts in the list of the lower number
        own, guests = group["own"].to_numpy(), role == "v"
        lists, column = np.unique(own, return_inverse=True)
        elsewhere = np.zeros((n, len(lists)), dtype=bool)
        if (own[guests] < home).any():
            for y in members:
                elsewhere[y] = np.isin(lists, group["visits"].iat[y]) & (lists < home)
        for k in range(0, len(queries), 256):
            some = queries[k:k + 256]
            rough = books[d].table_distance(points[some], home, codes) <= step + error[None, :] + 1e-4
            rough &= (role[some] != "b")[:, None] | (role[members] != "b")[None, :] | (some[:, None] < members[None, :])
            i, j = np.nonzero(rough)
            for c in range(0, len(i), 1 << 18):
                x, y = some[i[c:c + (1 << 18)]], members[j[c:c + (1 << 18)]]
                near = np.einsum("ij,ij->i", points[x], points[y]) >= threshold
                near &= ~(guests[x] & elsewhere[y, column[x]])
                x, y = x[near], y[near]
                np.add.at(linked, x, weight[y])
                np.add.at(linked, y, weight[x])
                while len(x):  # join the parts of linked nodes; each round the larger part takes the smaller's number
                    px, py = part[x], part[y]
                    apart = px != py
                    if not apart.any():
                        break
                    x, y, low, high = x[apart], y[apart], np.minimum(px, py)[apart], np.maximum(px, py)[apart]
                    np.minimum.at(part, high, low)
                    while (part[part] != part).any():
                        part = part[part]
        hit = linked > 0
        node = group["node"].to_numpy()
        return pd.DataFrame({"node": node[hit], "other": node[part[hit]], "linked": linked[hit]})

    return run


def pairs_of_blocks(indexed: DataFrame) -> DataFrame:
    """Rows of ``indexed`` dealt to pairs of blocks of each list.

    ``role``: b member and query, e member only, q query only (later block against an earlier one), v visitor.
    """
    cells = ["label", "d", "home"]
    none = F.array().cast("array<int>")
    visits = indexed.select("node", "label", "d", "embedding", "weight", "codes", "error", F.col("home").alias("own"), none.alias("lists"), F.explode("visits").alias("home"))
    sizes = indexed.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    guests = visits.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nv"))
    known = cut_lineage(sizes.join(guests, cells, "left").na.fill(0, ["nv"]))
    block = F.pmod(F.xxhash64("node"), F.col("nb").cast("bigint")).cast("int")
    own = indexed.withColumn("own", F.col("home")).withColumnRenamed("visits", "lists").join(known, cells).withColumn("at", block)
    # as member against later blocks and visitors' blocks (numbered from -1 down), as query against earlier blocks, both in its own
    own = own.select("*", F.explode(F.expr("""concat(
        array(struct(at AS eb, at AS qb, 'b' AS role)),
        transform(filter(sequence(0, nb - 1), x -> x > at), x -> struct(at AS eb, x AS qb, 'e' AS role)),
        transform(filter(sequence(0, nb - 1), x -> x < at), x -> struct(x AS eb, at AS qb, 'q' AS role)),
        transform(filter(sequence(0, nv), x -> x > 0), x -> struct(at AS eb, -x AS qb, 'e' AS role)))""")).alias("place"))
    came = visits.join(known, cells).withColumn("at", -1 - F.pmod(F.xxhash64("node"), F.col("nv").cast("bigint")).cast("int"))
    came = came.select("*", F.explode(F.expr("transform(sequence(0, nb - 1), x -> struct(x AS eb, at AS qb, 'v' AS role))")).alias("place"))
    columns = [*cells, "node", "embedding", "weight", "codes", "error", "own", F.col("lists").alias("visits"), "place.eb", "place.qb", "place.role"]
    return own.select(*columns).unionByName(came.select(*columns))


def near_duplicates(rows: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``rows`` (vec_id, embedding, label); an empty table stays empty, other columns are not read."""
    rows = rows.select("vec_id", "embedding", "label")
    nodes = distinct_vectors(rows)
    books = fit_codebooks(nodes)
    indexed = index(nodes, books, threshold)
    met = cut_lineage(pairs_of_blocks(indexed).groupBy("label", "d", "home", "eb", "qb")
                      .applyInPandas(compare(books, threshold), "node bigint, other bigint, linked bigint"))
    roots = components(met.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = met.groupBy("node").agg(F.sum("linked").alias("linked"))
    named = (nodes.join(roots, "node", "left").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node")))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = cut_lineage(named.join(smallest, "root").select("label", "embedding", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    # an unusable vector meets no node; a node's label and embedding equal those of its rows
    found = rows.join(known, ["label", "embedding"], "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE_SQL = """WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 u AS MATERIALIZED (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
 links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
 reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
 named AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
 counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
 SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN named ON vec_id = named.x LEFT JOIN counted ON vec_id = counted.x"""
