"""Random forest on histograms, as Spark jobs.

Rows are binned once and kept as blocks. All trees grow at once. A job per depth adds up weights by
(tree, node, drawn feature, bin, class) inside the tasks, then per node over all tasks, where its best
split is chosen. A node of few rows needs no more jobs: its rows meet in one group, which grows the
rest of its branch. Repeats of a row in a tree and the features of a node are drawn from the seed and
their place, so every job draws the same.
"""

from __future__ import annotations

import json
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork.plans.boosting import (
    BLOCK_TYPE,
    NODE_ROWS,
    PARTITION_BYTES,
    TASK_ROWS,
    _matrix,
    binned,
    blocks_of,
    fit_cuts,
    spread,
)
from legwork.session import scratch_path

# tasks get the functions of this module by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_TYPE = "tree int, node long, branch boolean, payload binary"
PART_SCHEMA = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("branch", pa.bool_()), ("payload", pa.binary())])
#: Bytes of one Arrow batch of parts.
BATCH_BYTES = 8 << 20


@dataclass
class Shape:
    """What all jobs of a fit share."""

    sizes: np.ndarray  # bins per feature
    n_classes: int
    drawn: int  # features a node may split on
    max_depth: int
    min_rows: int
    seed: int


@dataclass
class Top:
    """The nodes of a tree that whole jobs have decided on; ``place`` numbers nodes as in a heap."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])  # bins up to this one go left
    left: list[int] = field(default_factory=lambda: [0])  # the right child follows; 0: a leaf so far
    place: list[int] = field(default_factory=lambda: [1])
    shares: list[list[float]] = field(default_factory=lambda: [[]])

    def split(self, node: int, feature: int, cut: int) -> int:
        child = len(self.left)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, child
        for side in (0, 1):
            for name in ("feature", "cut", "left"):
                getattr(self, name).append(0)
            self.place.append(2 * self.place[node] + side)
            self.shares.append([])
        return child


@dataclass
class ForestTree:
    """Nodes as arrays: ``left`` is the left child, the right one follows; -1 - n is leaf n."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    shares: np.ndarray  # of the classes, per leaf

    def scores(self, bins: np.ndarray) -> np.ndarray:
        n, width = bins.shape
        flat, rows = np.ascontiguousarray(bins).reshape(-1), np.arange(n) * width
        at = np.zeros(n, np.int64)
        open_ = np.arange(n) if self.left[0] > 0 else np.arange(0)
        while len(open_):
            here = at[open_]
            at[open_] = here = self.left.take(here) + (flat.take(rows[open_] + self.feature.take(here)) > self.cut.take(here))
            open_ = open_[self.left.take(here) > 0]
        return self.shares[-1 - self.left.take(at)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of whole numbers, well mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_features(shape: Shape, tree: int, places: np.ndarray) -> np.ndarray:
    """(node, slot): the features a node may split on, ascending."""
    start = _mixed(np.array([shape.seed * 1_000_003 + tree + 1], np.uint64))
    own = _mixed(places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start)
    names = np.arange(1, len(shape.sizes) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    keys = _mixed(own[:, None] ^ names[None, :])
    return np.sort(np.argpartition(keys, shape.drawn - 1, axis=1)[:, : shape.drawn], axis=1)


def repeats(shape: Shape, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block stands in the tree's sample."""
    return np.random.default_rng([shape.seed, tree, block]).poisson(1.0, n)


def best_cuts(sums: np.ndarray, starts: np.ndarray, min_rows: int):
    """Best (gain, bin, left sums) per segment of bins, from (bin, [weight per class..., rows]).

    The gain is the fall of the Gini impurity times the weight of the node.
    """
    sizes = np.diff(starts)
    running = np.cumsum(sums, axis=0)
    before = np.concatenate([np.zeros((1, sums.shape[1])), running])[starts[:-1]]
    left = running - np.repeat(before, sizes, axis=0)
    whole = left[starts[1:] - 1]
    right = np.repeat(whole, sizes, axis=0) - left

    def purity(x):
        weight = x[:, :-1].sum(axis=1)
        return np.divide((x[:, :-1] ** 2).sum(axis=1), weight, out=np.zeros(len(x)), where=weight > 1e-12)

    base = purity(whole)
    gain = purity(left) + purity(right) - np.repeat(base, sizes)
    weight = np.repeat(whole[:, :-1].sum(axis=1), sizes)
    # sums differ in the last digits with the order of the rows
    gain = np.where(gain > 1e-9 * weight, gain, 0.0)
    gain[(left[:, -1] < min_rows) | (right[:, -1] < min_rows)] = -np.inf
    best = np.maximum.reduceat(gain, starts[:-1])
    same = np.flatnonzero(gain >= np.repeat(best - 1e-9 * np.abs(np.where(np.isfinite(best), best, 0.0)), sizes))
    at = same[np.searchsorted(same, starts[:-1])]
    return best, at - starts[:-1], left[at], whole


def grow(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, rows: np.ndarray, tree: int, place: int, shape: Shape):
    """The branch of a node whose rows are all here, level by level, and its gain per feature."""
    k, gains = shape.n_classes, np.zeros(len(shape.sizes))
    features, cuts, lefts, shares = [], [], [], []
    at, here, places = np.zeros(len(labels), np.int64), np.arange(len(labels)), np.array([place], np.int64)
    depth, n_nodes, n_leaves = int(place).bit_length() - 1, 1, 0
    while len(places):
        m = len(places)
        own, own_labels, own_rows = weights[here], labels[here], rows[here]
        whole = np.bincount(at * k + own_labels, own, m * k).reshape(m, k)
        gain, feature, cut = np.zeros(m), np.zeros(m, np.int64), np.zeros(m, np.int64)
        if depth < shape.max_depth:
            # a pure node or one of too few rows is a leaf
            able = (np.bincount(at, own_rows, m) >= 2 * shape.min_rows) & ((whole > 0).sum(axis=1) > 1)
            number, tried = np.cumsum(able) - 1, np.flatnonzero(able)
            inside = able[at]
            near, node = here[inside], number[at[inside]]
            w, c, r = own[inside], own_labels[inside], own_rows[inside]
            drawn = drawn_features(shape, tree, places[tried]) if len(tried) else np.zeros((0, 0), np.int64)
            for f in drawn.T:
                starts = np.r_[0, np.cumsum(shape.sizes[f])]
                cell = starts[node] + bins[f[node], near]
                sums = np.empty((starts[-1], k + 1))
                sums[:, :k] = np.bincount(cell * k + c, w, starts[-1] * k).reshape(-1, k)
                sums[:, k] = np.bincount(cell, r, starts[-1])
                found, where, _, _ = best_cuts(sums, starts, shape.min_rows)
                better = found > gain[tried]
                changed = tried[better]
                gain[changed], feature[changed], cut[changed] = found[better], f[better], where[better]
        parted = gain > 0
        np.add.at(gains, feature[parted], gain[parted])
        child = n_nodes + 2 * (np.cumsum(parted) - 1)
        total = whole.sum(axis=1, keepdims=True)
        leaf = -1 - (n_leaves + np.cumsum(~parted) - 1)
        features.append(feature)
        cuts.append(cut)
        lefts.append(np.where(parted, child, leaf))
        shares.append((whole / np.where(total > 0, total, 1.0))[~parted])
        n_leaves += int((~parted).sum())
        # the rows of parted nodes go on
        goes = parted[at]
        here, at = here[goes], at[goes]
        right = bins[feature[at], here] > cut[at]
        at = 2 * (np.cumsum(parted) - 1)[at] + right
        places = np.stack([2 * places[parted], 2 * places[parted] + 1], axis=1).ravel()
        n_nodes += len(places)
        depth += 1
    made = ForestTree(
        np.concatenate(features).astype(np.int16), np.concatenate(cuts).astype(np.uint8),
        np.concatenate(lefts).astype(np.int32), np.concatenate(shares).astype(np.float32),
    )
    return made, gains


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += len(row[3])
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), PART_SCHEMA)], schema=PART_SCHEMA)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), PART_SCHEMA)], schema=PART_SCHEMA)


def partial_sums(state, shape: Shape):
    """Blocks to the sums and rows of the open nodes, a tree at a time."""
    k, width = shape.n_classes, len(shape.sizes)

    def parts(blocks: list[tuple], tops: list[Top], wanted: list[tuple[list[int], list[int]]]) -> Iterator[tuple]:
        for t, (top, (big, small)) in enumerate(zip(tops, wanted)):
            if not big and not small:
                continue
            feature, cut, left = np.array(top.feature), np.array(top.cut), np.array(top.left)
            kind = np.full(len(left), -1)
            kind[big] = np.arange(len(big))
            kind[small] = np.arange(len(small)) + len(big)
            drawn = drawn_features(shape, t, np.array(top.place)[big]) if big else np.zeros((0, shape.drawn), np.int64)
            starts = np.r_[0, np.cumsum(shape.sizes[drawn].ravel())]
            first = starts[:-1].reshape(drawn.shape)
            sums = np.zeros((starts[-1], k + 1))
            for number, bins, labels, weights in blocks:
                count = repeats(shape, t, number, len(labels))
                rows = np.flatnonzero(count)
                at = np.zeros(len(rows), np.int64)
                while True:
                    inner = left[at] > 0
                    if not inner.any():
                        break
                    at = np.where(inner, left[at] + (bins[rows, feature[at]] > cut[at]), at)
                place = kind[at]
                rows, place = rows[place >= 0], place[place >= 0]
                count, label = count[rows], labels[rows].astype(np.int64)
                weight = weights[rows] * count
                inside = place < len(big)
                if inside.any():
                    node, own = place[inside], rows[inside]
                    cells = first[node] + bins[own[:, None], drawn[node]]
                    m = cells.shape[1]
                    keys = (cells * k + label[inside, None]).ravel()
                    sums[:, :k] += np.bincount(keys, np.repeat(weight[inside], m), starts[-1] * k).reshape(-1, k)
                    sums[:, k] += np.bincount(cells.ravel(), np.repeat(count[inside], m), starts[-1])
                if not inside.all():
                    order = np.argsort(place, kind="stable")
                    ends = np.searchsorted(place[order], np.arange(len(big), len(big) + len(small) + 1))
                    for i, node in enumerate(small):
                        own = order[ends[i] : ends[i + 1]]
                        if len(own):
                            # one feature after the other, which packs better
                            payload = (
                                weight[own].tobytes() + count[own].astype(np.uint8).tobytes()
                                + label[own].astype(np.uint8).tobytes() + np.ascontiguousarray(bins[rows[own]].T).tobytes()
                            )
                            yield t, top.place[node], True, payload
            for i, node in enumerate(big):
                part = sums[first[i, 0] : first[i, -1] + shape.sizes[drawn[i, -1]]]
                if part.any():
                    yield t, top.place[node], False, part.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, wanted = pickle.loads(state.value)
        blocks = []  # at most PARTITION_BYTES of bins
        for batch in batches:
            for number, bins, labels, weights in zip(*(batch.column(c) for c in ("block", "bins", "labels", "weights"))):
                own = np.frombuffer(labels.as_buffer(), np.int16)
                blocks.append((
                    number.as_py(), np.frombuffer(bins.as_buffer(), np.uint8).reshape(len(own), width), own,
                    np.frombuffer(weights.as_buffer()),
                ))
        yield from _batches(parts(blocks, tops, wanted))

    return run


def choose(shape: Shape):
    """Parts of one node to its best split, or to its whole branch."""
    k, width = shape.n_classes, len(shape.sizes)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place, branch = (x.as_py() for x in key)
        payloads = (x.as_buffer() for batch in batches for x in batch.column(3))
        if branch:
            parts = []
            for raw in payloads:
                n = len(raw) // (10 + width)
                parts.append((
                    np.frombuffer(raw, count=n), np.frombuffer(raw, np.uint8, n, 8 * n), np.frombuffer(raw, np.uint8, n, 9 * n),
                    np.frombuffer(raw, np.uint8, offset=10 * n).reshape(width, n),
                ))
            weights, count, labels = (np.concatenate([p[i] for p in parts]) for i in range(3))
            bins = np.concatenate([p[3] for p in parts], axis=1)
            made, gains = grow(bins, labels.astype(np.int64), weights, count, tree, place, shape)
            found = (made.feature, made.cut, made.left, made.shares), gains
        else:
            drawn = drawn_features(shape, tree, np.array([place]))[0]
            starts = np.r_[0, np.cumsum(shape.sizes[drawn])]
            sums = sum(np.frombuffer(p) for p in payloads).reshape(-1, k + 1)
            gain, cut, left, whole = best_cuts(sums, starts, shape.min_rows)
            best = int(np.argmax(gain))
            found = float(gain[best]), int(drawn[best]), int(cut[best]), left[best], whole[best]
        row = [pa.array([tree], pa.int32()), pa.array([place], pa.int64()), pa.array([branch]), pa.array([pickle.dumps(found)], pa.binary())]
        yield pa.RecordBatch.from_arrays(row, schema=PART_SCHEMA)

    return run


def _shares(weights: np.ndarray) -> list[float]:
    return (weights / (weights.sum() or 1.0)).tolist()


def joined(top: Top, branches: dict[int, ForestTree], n_classes: int) -> ForestTree:
    """The tree with its branches in the places of the open leaves of its top."""
    feature, cut, left = [np.array(top.feature)], [np.array(top.cut)], [np.array(top.left)]
    shares, size, n_leaves = [], len(top.left), 0
    for node, own in enumerate(top.shares):
        branch = branches.get(top.place[node])
        if top.left[node]:
            continue
        if branch is None:
            left[0][node] = -1 - n_leaves
            shares.append(np.array([own or [1.0 / n_classes] * n_classes], np.float32))
            n_leaves += 1
            continue
        moved = np.where(branch.left > 0, branch.left + size - 1, branch.left - n_leaves)
        feature[0][node], cut[0][node], left[0][node] = branch.feature[0], branch.cut[0], moved[0]
        feature.append(branch.feature[1:])
        cut.append(branch.cut[1:])
        left.append(moved[1:])
        shares.append(branch.shares)
        size, n_leaves = size + len(moved) - 1, n_leaves + len(branch.shares)
    return ForestTree(
        np.concatenate(feature).astype(np.int16), np.concatenate(cut).astype(np.uint8),
        np.concatenate(left).astype(np.int32), np.concatenate(shares),
    )


class _Settings(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a child", TypeConverters.toInt)
    featureSubsetStrategy = Param(
        Params._dummy(), "featureSubsetStrategy", "features a node may split on: auto, sqrt, log2, onethird or all", TypeConverters.toString
    )


class HistogramForest(Estimator, _Settings, MLWritable):
    """Trees for classes 0..k-1 by Gini impurity; each sees every row Poisson(1) times."""

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._setDefault(
            featuresCol="features", labelCol="label", seed=42, numTrees=20, maxDepth=5, maxBins=32, minInstancesPerNode=1,
            featureSubsetStrategy="auto",
        )
        self._set(**self._input_kwargs)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return DefaultParamsReader(cls)

    def _drawn(self, width: int) -> int:
        rule = self.getOrDefault(self.featureSubsetStrategy)
        if rule == "auto":
            rule = "sqrt" if self.getOrDefault(self.numTrees) > 1 else "all"
        known = {
            "sqrt": int(np.ceil(np.sqrt(width))), "log2": max(1, int(np.ceil(np.log2(width)))),
            "onethird": int(np.ceil(width / 3)), "all": width,
        }
        if rule not in known:
            raise ValueError(f"Unsupported featureSubsetStrategy: {rule}")
        return known[rule]

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get = self.getOrDefault
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"),
            weight.alias("weight"), F.lit(False).alias("held"),
        )
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top")).first()
        if not seen["n"]:
            raise ValueError("There are no rows to fit")
        cuts = fit_cuts(rows.select("x"), get(self.maxBins))
        shape = Shape(
            np.array([len(c) + 1 for c in cuts]), seen["top"] + 1, self._drawn(len(cuts)), get(self.maxDepth),
            max(1, get(self.minInstancesPerNode)), get(self.seed),
        )
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        parts = max(min(cores, -(-seen["n"] // TASK_ROWS)), -(-seen["n"] * (len(cuts) + 10) // PARTITION_BYTES))
        path = scratch_path(dataset.sparkSession, "forest-blocks")
        rows.repartition(parts).mapInArrow(blocks_of(cuts, np.zeros(0)), BLOCK_TYPE).write.parquet(path)
        trees, gains = self._grown(dataset.sparkSession, path, parts, shape, seen["n"])
        return self._copyValues(ForestModel(trees=trees, cuts=cuts, gains=gains))

    def _grown(self, spark, path: str, parts: int, shape: Shape, n_rows: int):
        n_trees, cores = self.getOrDefault(self.numTrees), spark.sparkContext.defaultParallelism
        # the jobs below have no plan to improve at run time
        session = spark.newSession()
        session.conf.set("spark.sql.adaptive.enabled", "false")
        blocks = session.read.parquet(path).select("block", "bins", "labels", "weights").coalesce(parts).persist()
        tops, gains = [Top() for _ in range(n_trees)], np.zeros((n_trees, len(shape.sizes)))
        branches: list[dict[int, ForestTree]] = [{} for _ in tops]
        sizes = [{0: n_rows} for _ in tops]  # rows of the open nodes
        while any(sizes):
            wanted = [([n for n in s if s[n] > NODE_ROWS], [n for n in s if s[n] <= NODE_ROWS]) for s in sizes]
            state = spread(spark, (tops, wanted))
            groups = blocks.mapInArrow(partial_sums(state, shape), PART_TYPE).repartition(
                max(parts, 4 * cores), "tree", "node", "branch"
            ).groupBy("tree", "node", "branch")
            answers = groups.applyInArrow(choose(shape), PART_TYPE).collect()  # a row per node, of the trees only
            state.destroy()
            nodes = [{top.place[n]: n for n in s} for top, s in zip(tops, sizes)]
            sizes = [{} for _ in tops]
            for r in sorted(answers, key=lambda r: (r["tree"], r["node"])):
                t, top, found = r["tree"], tops[r["tree"]], pickle.loads(r["payload"])
                if r["branch"]:
                    branches[t][r["node"]] = ForestTree(*found[0])
                    gains[t] += found[1]
                    continue
                gain, feature, cut, left, whole = found
                node = nodes[t][r["node"]]
                if gain > 0 and r["node"].bit_length() - 1 < shape.max_depth:
                    gains[t, feature] += gain
                    child = top.split(node, feature, cut)
                    for n, part in ((child, left), (child + 1, whole - left)):
                        top.shares[n] = _shares(part[:-1])
                        if top.place[n].bit_length() - 1 < shape.max_depth:
                            sizes[t][n] = int(round(part[-1]))
                else:
                    top.shares[node] = _shares(whole[:-1])
        blocks.unpersist()
        return [joined(top, b, shape.n_classes) for top, b in zip(tops, branches)], gains


_ARRAYS = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "shares": np.float32}


class _ModelReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        whole = json.loads(spark.read.text(f"{path}/model").first()[0])
        trees = []
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect():  # a row per tree
            arrays = {n: np.frombuffer(r[n], kind) for n, kind in _ARRAYS.items()}
            arrays["shares"] = arrays["shares"].reshape(-1, whole["classes"])
            trees.append(ForestTree(**arrays))
        return ForestModel(trees=trees, cuts=whole["cuts"], gains=np.array(whole["gains"]))._set(**whole["columns"])


class _ModelWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        whole = {
            "cuts": m.cuts, "gains": m.gains.tolist(), "classes": m.numClasses,
            "columns": {"featuresCol": m.getFeaturesCol(), "labelCol": m.getLabelCol()},
        }
        spark = self.sparkSession
        spark.createDataFrame([(json.dumps(whole),)], "value string").write.text(f"{path}/model")
        rows = [(i, *[bytearray(getattr(t, n).astype(k).tobytes()) for n, k in _ARRAYS.items()]) for i, t in enumerate(m.trees)]
        schema = "tree int, " + ", ".join(f"{n} binary" for n in _ARRAYS)
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/trees")


class ForestModel(Model, _Settings, MLWritable, MLReadable):
    """The trees, the borders of the bins, and what each feature gained per tree."""

    def __init__(self, trees=(), cuts=(), gains=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.trees, self.cuts = list(trees), list(cuts)
        self.gains = np.zeros((0, len(self.cuts))) if gains is None else gains

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    @property
    def numClasses(self) -> int:
        return self.trees[0].shares.shape[1]

    @property
    def featureImportances(self) -> DenseVector:
        """Gain per feature as shares of each tree, added up, as shares."""
        own = self.gains.sum(axis=1, keepdims=True)
        summed = (self.gains / np.where(own > 0, own, 1.0)).sum(axis=0)
        return Vectors.dense(summed / (summed.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = spread(dataset.sparkSession, (self.trees, self.cuts))

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def votes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            trees, cuts = pickle.loads(state.value)
            for x in batches:
                bins = binned(_matrix(x), cuts)
                scores = np.zeros((len(bins), trees[0].shares.shape[1]))
                for tree in trees:
                    scores += tree.scores(bins)
                offsets = np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32)
                yield pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))

        n = float(len(self.trees))
        found = dataset.withColumn("_v", votes(vector_to_array(self.getFeaturesCol())))
        best = F.array_position("_v", F.array_max("_v")) - 1
        return found.withColumns({
            "rawPrediction": array_to_vector("_v"),
            "probability": array_to_vector(F.transform("_v", lambda v: v / F.lit(n))),
            "prediction": best.cast("double"),
        }).drop("_v")
