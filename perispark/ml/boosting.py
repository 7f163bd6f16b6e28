"""Boosted trees: the trees that Spark ML's learner grows, from sums over blocks of binned rows.

Spark's learner visits a row's features one by one, as objects, in every level of every tree. Here a partition is a few
blocks of numbers: a level is one job that adds up counts, sums and squares per node, feature and bin of whole blocks, and
the driver picks the splits by Spark's rule. Bins, residuals, gains and ties are Spark's, and so is the fitted model. Blocks
are kept as bytes: a byte for each feature of a row, and 16 more. Models of several tables grow side by side: a level of
all of them is one job, as a job costs more than the sums of a small table.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from perispark.session import find_package, use_checkpoint_dir

BLOCK_ROWS = 32_768
TASK_ROWS = 100_000  # fewer are not worth a task
SAMPLED_ROWS = 10_000  # that bins are set by; fewer rows are all taken
PURE = 2.0 ** -52  # impurity below which a node is not split
NODES_SCHEMA = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
                "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")

Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]  # number of the table, bins (feature by row), targets, sums of the trees so far
Splits = list[tuple[np.ndarray, np.ndarray]]  # of each level: feature and last bin that goes left, by place; where a node is not split all rows go left


# ---- bins ----
def feature_limits(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Upper limits of all bins but the last, from sampled values: halfway between neighbours, by equal shares of the rows.

    Of ``expected`` rows those that were not seen count as zeros, as Spark has it.
    """
    seen, counts = np.unique(values[values != 0.0], return_counts=True)
    present = float(counts.sum())
    if len(seen) and expected - present > PURE * present * present:
        at = int(np.searchsorted(seen, 0.0))
        seen, counts = np.insert(seen, at, 0.0), np.insert(counts.astype(float), at, expected - present)
    middles = (seen[:-1] + seen[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = expected / bins
    target, upto, limits = stride, 0.0, []
    for i, n in enumerate(counts.tolist()):
        before, upto = upto, upto + n
        if i and abs(before - target) < abs(upto - target):
            limits.append(middles[i - 1])
            target += stride
    return np.array(limits)


def _sampled(rows: DataFrame, n: int, seed: int) -> tuple[np.ndarray, float]:
    """(feature by sampled row, expected number of rows), drawn as Spark's learner draws them."""
    spark, share = rows.sparkSession, min(1.0, SAMPLED_ROWS / n)
    if share < 1.0:
        jvm = spark.sparkContext._jvm
        drawn = rows._jdf.toJavaRDD().sample(False, share, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    return np.array([r.x for r in rows.select("x").collect()], dtype=float).T, share * n


def _binned(limits: list[np.ndarray], signs: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow pass from feature arrays and labels to blocks; ``signs`` turns labels of 0 and 1 into -1 and 1."""
    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        y = rows["y"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
        if not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError("a feature or label is missing or not a finite number")
        if signs and not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("labels have to be 0 or 1")
        bins = np.array([np.searchsorted(at, x[:, j]) for j, at in enumerate(limits)], dtype=np.uint8)
        y = y * 2 - 1 if signs else y
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (bins, y)], ["bins", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            while held + batch.num_rows >= BLOCK_ROWS:
                parts.append(batch.slice(0, BLOCK_ROWS - held))
                batch = batch.slice(BLOCK_ROWS - held)
                yield block(parts)
                parts, held = [], 0
            if batch.num_rows:
                parts.append(batch)
                held += batch.num_rows
        if held:
            yield block(parts)

    return run


def _block(table: int, row: Row) -> Block:
    y = np.frombuffer(row.y)
    for kind in (np.int8, np.float32):  # blocks are read in every level, so targets take no more bytes than they need
        with np.errstate(invalid="ignore", over="ignore"):
            if (y.astype(kind) == y).all():
                y = y.astype(kind)
                break
    return table, np.frombuffer(row.bins, np.uint8).reshape(-1, len(y)), y, np.zeros(len(y))


# ---- trees ----
@dataclass
class Tree:
    """Splits and nodes by level and place in the level; the node at place ``p`` has its children at ``2 p`` and ``2 p + 1``."""

    splits: Splits = field(default_factory=list)
    nodes: dict[tuple[int, int], dict] = field(default_factory=dict)  # sums, impurity, and gain, feature and limit of a split

    def values(self) -> np.ndarray:
        """The prediction at each place below the last level."""
        depth = len(self.splits)
        found = np.zeros(1 << depth)
        for (level, place), node in self.nodes.items():
            if "gain" not in node:
                found[place << (depth - level)] = node["sums"][1] / node["sums"][0]
        return found


def _places(splits: Splits, bins: np.ndarray) -> np.ndarray:
    """Where each row of a block stands below the last level."""
    n = bins.shape[1]
    at, flat, row = np.zeros(n, np.intp), bins.ravel(), np.arange(n)
    for level, (features, cuts) in enumerate(splits):
        if level == 0:
            at += bins[features[0]] > cuts[0]
            continue
        cell = (features * n).take(at)
        cell += row
        right = flat.take(cell) > cuts.take(at)
        at += at
        at += right
    return at


# e^x as Java's Math.exp has it on x86: 2^(j/64) from a table in two parts, and a polynomial of degree six for the rest
_POWERS = np.exp2(np.arange(64, dtype=np.longdouble) / 64)
_HIGH = np.where(_POWERS.astype(float) <= _POWERS, _POWERS.astype(float), np.nextafter(_POWERS.astype(float), 0.0))
_LOW = ((_POWERS - _HIGH) / _HIGH).astype(float)
_STEPS, _STEP_HIGH, _STEP_LOW = (float.fromhex(x) for x in ("0x1.71547652b82fep+6", "0x1.62e42fefap-7", "0x1.cf79abc9e3b39p-46"))
_HALF, _C3, _C4, _C5, _C6 = (float.fromhex(x) for x in ("0x1.ffffffffffffep-2", "0x1.5555555548ba1p-3", "0x1.55555555b9e25p-5", "0x1.11115c090cf0fp-7", "0x1.6c15ce3289860p-10"))


def _exp(x: np.ndarray) -> np.ndarray:
    """e to the power of ``x``, rounded as Spark's learner has it: another last digit can decide between equal splits."""
    x = np.clip(x, -750.0, 750.0)
    steps = np.rint(x * _STEPS)
    whole = steps.astype(np.int64)
    place, r = whole & 63, (x - steps * _STEP_HIGH) - steps * _STEP_LOW
    r2 = r * r
    p = ((_LOW.take(place) + r + (r2 * (_C5 + _C6 * r)) * (r2 * r)) + (r2 * r) * (_C3 + _C4 * r)) + _HALF * r2
    high = _HIGH.take(place)
    return np.ldexp(high + high * p, whole >> 6)


def _residuals(y: np.ndarray, so_far: np.ndarray, first: bool, signs: bool) -> np.ndarray:
    """What the next tree is fitted on: the targets, then the falling slope of squared error or log loss."""
    if first:
        return y.astype(float)
    if signs:
        with np.errstate(over="ignore"):
            return 4.0 * y / (1.0 + _exp(2.0 * y * so_far))
    return 2.0 * (y - so_far)


@dataclass
class Level:
    """What a table's blocks need to know to add up a level of its tree."""

    splits: Splits
    slots: np.ndarray  # of a place: its number among those that may be split, or their count
    active: int
    used: list[int]  # features with more than one bin
    width: int  # most bins of a feature


def _sums(levels: dict[int, Level], first: bool, signs: bool, blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
    """Count, sum and sum of squares per feature, node and bin of each table over a partition."""
    found = {}
    for table, bins, y, so_far in blocks:
        if table not in levels:
            continue
        level = levels[table]
        size = (level.active + 1) * level.width
        if table not in found:
            found[table] = np.zeros((3, len(level.used), size))
        r = _residuals(y, so_far, first, signs)
        squares = r * r
        base = (level.slots * level.width).take(_places(level.splits, bins))
        at = np.empty_like(base)
        for i, j in enumerate(level.used):
            np.add(base, bins[j], out=at)
            for k, weights in enumerate((None, r, squares)):
                found[table][k, i] += np.bincount(at, weights, size)
    for table, sums in found.items():
        yield table, sums.reshape(*sums.shape[:2], -1, levels[table].width)[:, :, :-1]


def _advance(moves: list[tuple[Splits, np.ndarray]], block: Block) -> Block:
    """A block with what its table's last tree adds to the rows."""
    table, bins, y, so_far = block
    splits, values = moves[table]
    return table, bins, y, so_far + values.take(_places(splits, bins))


def _merged(parts: Sequence[RDD], rows: int) -> RDD:
    """The blocks of all tables, in as many partitions as there are cores and rows for."""
    context, whole = parts[0].context, parts[0].context.union(list(parts)) if len(parts) > 1 else parts[0]
    n = whole.getNumPartitions()
    share = -(-n // max(1, min(n, context.defaultParallelism, -(-rows // TASK_ROWS))))
    return whole.coalesce(-(-n // share)) if len(parts) > 1 else whole


def _level_sums(blocks: RDD, levels: dict[int, Level], first: bool, signs: bool) -> dict[int, np.ndarray]:
    """The sums of a level of each table's tree, from one job."""
    found: dict[int, np.ndarray] = {}
    for table, sums in blocks.mapPartitions(partial(_sums, levels, first, signs)).collect():
        found[table] = found[table] + sums if table in found else sums
    return found


def _impurity(count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


def _split_level(tree: Tree, sums: np.ndarray, used: list[int], limits: list[np.ndarray], places: list[int], depth: int) -> list[int]:
    """Put the splits of a level into the tree; return the places of the next level that may be split again."""
    level, upto = len(tree.splits), sums.cumsum(axis=-1)
    if level == 0:
        root = upto[:, 0, 0, 0] + (upto[:, 0, 0, -1] - upto[:, 0, 0, 0])
        tree.nodes[0, 0] = {"sums": root, "impurity": float(_impurity(*root))}
    if level == depth:
        return []
    left, right = upto[..., :-1], upto[..., -1:] - upto[..., :-1]
    impurity = np.array([tree.nodes[level, p]["impurity"] for p in places])[None, :, None]
    below = _impurity(*left), _impurity(*right)
    both = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = impurity - left[0] / both * below[0] - right[0] / both * below[1]
    known = np.arange(left.shape[-1]) < np.array([len(limits[j]) for j in used])[:, None, None]
    gain = np.where(known & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf).transpose(1, 0, 2).reshape(len(places), -1)
    features, cuts, following = np.zeros(1 << level, np.intp), np.full(1 << level, 255, np.uint8), []
    for i, p in enumerate(places):
        best = int(gain[i].argmax()) if gain.shape[1] else 0
        if not gain.shape[1] or not gain[i, best] > 0:
            continue
        f, cut = divmod(best, left.shape[-1])
        features[p], cuts[p] = used[f], cut
        tree.nodes[level, p] |= {"gain": float(gain[i, best]), "feature": used[f], "limit": float(limits[used[f]][cut])}
        for side, child in enumerate((left, right)):
            found = float(below[side][f, i, cut])
            tree.nodes[level + 1, 2 * p + side] = {"sums": child[:, f, i, cut], "impurity": found}
            if level + 1 < depth and abs(found) >= PURE:
                following.append(2 * p + side)
    tree.splits.append((features, cuts))
    return following


def _stored_nodes(tree: Tree, number: int) -> list[tuple]:
    """A tree's nodes as Spark ML stores them, in preorder; two leaves that predict the same become one."""
    def below(level: int, place: int) -> tuple:
        node = tree.nodes[level, place]
        children = [below(level + 1, 2 * place + side) for side in (0, 1)] if "gain" in node else []
        value = float(node["sums"][1] / node["sums"][0])
        if children and not any(c[1] for c in children) and children[0][2] == children[1][2]:
            children, value = [], children[0][2]
        return node, children, value

    found: list[tuple] = []

    def lay(item: tuple) -> int:
        (node, children, value), at = item, len(found)
        found.append(())
        left, right = [lay(c) for c in children] or (-1, -1)
        split = (node["feature"], [node["limit"]], -1) if children else (-1, [], -1)
        sums = [float(v) for v in node["sums"]]
        found[at] = (number, (at, value, node["impurity"], sums, int(sums[0]), node["gain"] if children else -1.0, left, right, split))
        return at

    lay(below(0, 0))
    return found


def _forget(spark: SparkSession, rdd: RDD) -> None:
    """Remove the checkpoint of rows that a later one has replaced."""
    if file := rdd.getCheckpointFile():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class BoostedTrees:
    """Fits what ``kind``, a boosted learner of Spark ML with squared error or log loss, describes; see the module."""

    def __init__(self, kind: GBTRegressor | GBTClassifier):
        self.kind = kind

    @staticmethod
    def kept_bytes(features: int) -> int:
        """Of a row: its block before and after a tree is added."""
        return 2 * (features + 16)

    def fit(self, df: DataFrame) -> GBTRegressionModel | GBTClassificationModel:
        return self.fit_all([df])[0]

    def fit_all(self, tables: Sequence[DataFrame]) -> list[GBTRegressionModel | GBTClassificationModel]:
        """One model for each of ``tables``."""
        spark, kind = tables[0].sparkSession, self.kind
        find_package(spark)
        use_checkpoint_dir(spark)
        with ThreadPoolExecutor(len(tables)) as pool:
            sizes, limits, parts = zip(*pool.map(self._prepared, range(len(tables)), tables))
        blocks = _merged(parts, sum(sizes)).persist(StorageLevel.MEMORY_AND_DISK)
        weights, every, stored = [1.0] + [kind.getStepSize()] * (kind.getMaxIter() - 1), kind.getCheckpointInterval(), []
        grown: list[list[Tree]] = [[] for _ in tables]
        for m in range(len(weights)):
            before = None
            if m:
                moves = [(trees[-1].splits, weights[m - 1] * trees[-1].values()) for trees in grown]
                before, blocks = blocks, blocks.map(partial(_advance, moves)).persist(StorageLevel.MEMORY_AND_DISK)
                if every > 0 and m % every == 0:
                    blocks.checkpoint()
                    stored.append(blocks)
            for trees, tree in zip(grown, self._trees(blocks, before, limits, m == 0)):
                trees.append(tree)
            if len(stored) > 1:
                _forget(spark, stored.pop(0))
        blocks.unpersist()
        for rdd in stored:
            _forget(spark, rdd)
        return [self._model(spark, trees, weights, len(at)) for trees, at in zip(grown, limits)]

    def _prepared(self, table: int, df: DataFrame) -> tuple[int, list[np.ndarray], RDD]:
        """(number of rows, limits of the bins, blocks) of a table."""
        rows = df.select(vector_to_array(self.kind.getFeaturesCol()).alias("x"), F.col(self.kind.getLabelCol()).cast("double").alias("y"))
        n = rows.count()
        if not n:
            raise ValueError("no rows to fit trees on")
        values, expected = _sampled(rows, n, self.kind.getSeed())
        limits = [feature_limits(v, expected, min(self.kind.getMaxBins(), n)) for v in values]
        return n, limits, rows.mapInArrow(_binned(limits, self._signs), "bins binary, y binary").rdd.map(partial(_block, table))

    @property
    def _signs(self) -> bool:
        return isinstance(self.kind, GBTClassifier)

    def _trees(self, blocks: RDD, before: RDD | None, limits: Sequence[list[np.ndarray]], first: bool) -> list[Tree]:
        """The next tree of every table; ``before`` is no longer needed once ``blocks`` are there."""
        used = [[j for j, at in enumerate(of) if len(at)] or [0] for of in limits]
        trees, places, depth = [Tree() for _ in limits], {i: [0] for i in range(len(limits))}, self.kind.getMaxDepth()
        for number in range(max(depth, 1)):
            levels = {}
            for i, active in places.items():
                slots = np.full(1 << number, len(active), np.intp)
                slots[active] = np.arange(len(active))
                levels[i] = Level(trees[i].splits, slots, len(active), used[i], max(len(at) for at in limits[i]) + 1)
            sums = _level_sums(blocks, levels, first, self._signs)
            if number == 0 and before is not None:
                before.unpersist()
            places = {i: _split_level(trees[i], sums[i], used[i], limits[i], active, depth) for i, active in places.items()}
            places = {i: active for i, active in places.items() if active}
            if not places:
                break
        return trees

    def _model(self, spark: SparkSession, trees: list[Tree], weights: list[float], features: int) -> GBTRegressionModel | GBTClassificationModel:
        """The trees as Spark's model, by way of the files that Spark itself would store."""
        made, name = (GBTClassificationModel, "classification.GBTClassificationModel") if self._signs else (GBTRegressionModel, "regression.GBTRegressionModel")
        path = f"{use_checkpoint_dir(spark)}/boosted-{uuid4().hex}"
        DefaultParamsWriter.saveMetadata(self.kind, path, spark, {"class": f"org.apache.spark.ml.{name}", "numFeatures": features, "numTrees": len(trees)})
        one = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
               "paramMap": {"maxDepth": self.kind.getMaxDepth(), "seed": self.kind.getSeed()}, "defaultParamMap": {}}
        about = [(i, json.dumps(one | {"uid": f"dtr_{uuid4().hex[-12:]}"}), w) for i, w in enumerate(weights)]
        spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = [node for i, tree in enumerate(trees) for node in _stored_nodes(tree, i)]
        spark.createDataFrame(nodes, NODES_SCHEMA, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
        return made.load(path)
