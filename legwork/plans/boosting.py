"""Multiclass gradient boosting on histograms, as Spark jobs.

Rows are binned once and kept as blocks. Every round grows one tree per class, all classes at
once. A job per depth adds up gradients, hessians and counts by (class, node, feature, bin): inside
the tasks for their own rows, then per group of features over all tasks, where the best split of the
group is chosen. Only the best splits reach the driver. A node of few rows needs no more jobs: its
rows meet in one group, which grows the rest of its branch. Rows that fit into one partition need no
job per round: a task per class keeps them for the whole fit, and the tasks exchange their trees.
"""

from __future__ import annotations

import json
import pickle
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, Broadcast, TaskContext, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork.session import scratch_path

# tasks get the functions of this module by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of one block, least rows worth a task, and bytes of binned rows of one partition.
BLOCK_ROWS, TASK_ROWS, PARTITION_BYTES = 32_768, 4096, 64 << 20
#: A node of at most so many rows is finished by one task.
NODE_ROWS = 16_384
#: Bins whose sums travel together.
SLICE_BINS = 4096
#: Rounds after which the scores of the rows are written again.
STORE_ROUNDS = 16
#: Rounds without a lower error after which boosting stops, and the fall that counts as lower.
PATIENCE, FALL = 15, 1e-7

BLOCK_TYPE = "block long, bins binary, labels binary, weights binary, held binary, scores binary"
BLOCK_SCHEMA = pa.schema([("block", pa.int64()), *[(n, pa.binary()) for n in ("bins", "labels", "weights", "held", "scores")]])
PART_TYPE = "cls int, node int, slice int, payload binary"
PART_SCHEMA = pa.schema([("cls", pa.int32()), ("node", pa.int32()), ("slice", pa.int32()), ("payload", pa.binary())])
LOSS = -1  # the class of rows that carry the held-out loss


def stalled(errors: list[float], patience: int = PATIENCE, fall: float = FALL) -> bool:
    """None of the last ``patience`` errors is lower than the one before them."""
    if len(errors) <= patience:
        return False
    return min(errors[-patience:]) >= errors[-patience - 1] - fall


# --- trees ------------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes by number; node 0 is the root, a node without children is a leaf."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])  # bins up to this one go left
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        children = len(self.left), len(self.left) + 1
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = children
        for _ in children:
            for name, new in (("feature", 0), ("cut", 0), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0)):
                getattr(self, name).append(new)
            self.depth.append(self.depth[node] + 1)
        return children

    def graft(self, node: int, branch: Tree) -> None:
        """Puts ``branch`` in the place of a leaf."""
        self.value[node] = branch.value[0]
        places = {0: node}
        for n in range(len(branch.left)):
            if branch.left[n]:
                pair = self.split(places[n], branch.feature[n], branch.cut[n], branch.gain[n])
                for child, place in zip((branch.left[n], branch.right[n]), pair):
                    places[child] = place
                    self.value[place] = branch.value[child]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of the bin matrix."""
        n, width = bins.shape
        flat, rows = np.ascontiguousarray(bins).reshape(-1), np.arange(n) * width
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        own = np.arange(len(left))
        # a leaf is its own child, so rows that have arrived stay
        children = np.stack([np.where(left > 0, left, own), np.where(left > 0, right, own)], axis=1).ravel()
        at = np.zeros(n, np.int64)
        for _ in range(max(self.depth)):
            goes_right = flat.take(rows + feature.take(at)) > cut.take(at)
            at = children.take(2 * at + goes_right)
        return at


@dataclass
class Rules:
    """What a split must keep to."""

    max_depth: int
    l2: float
    min_rows: int
    min_hessian: float
    step: float
    hessian_factor: float

    def value(self, g: float, h: float) -> float:
        return -self.step * g / (h + self.l2) if h + self.l2 > 0 else 0.0


class Layout:
    """Bins of all features in one row: feature f has bins starts[f] to starts[f + 1]."""

    def __init__(self, sizes: list[int]):
        self.sizes = np.array(sizes)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.total = int(self.starts[-1])
        self.feature_of = np.repeat(np.arange(len(sizes)), self.sizes)
        self.last = np.zeros(self.total, bool)
        self.last[self.starts[1:] - 1] = True  # nothing lies to the right of a feature's last bin
        # features of two bins are summed by a product of matrices
        self.narrow, self.wide = (np.flatnonzero(x) for x in (self.sizes <= 2, self.sizes > 2))
        # features of one slice hold about SLICE_BINS bins
        self.slices = np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(self.starts[:-1] // SLICE_BINS)) + 1)

    def sums(self, by_feature: np.ndarray, at: np.ndarray, n_nodes: int, columns: list[np.ndarray | None]) -> np.ndarray:
        """(node, bin, column): sums of the columns over the rows, ``at`` names each row's node, ascending; None counts rows.

        ``by_feature`` holds a row of bins per feature, so that one feature's bins lie together.
        """
        found = np.empty((n_nodes, self.total, len(columns)))
        at = at.astype(np.int64)
        for f in self.wide.tolist():
            size = int(self.sizes[f])
            place = by_feature[f] + at * size if n_nodes > 1 else by_feature[f]
            span = slice(self.starts[f], self.starts[f + 1])
            for i, c in enumerate(columns):
                found[:, span, i] = np.bincount(place, c, n_nodes * size).reshape(n_nodes, size)
        if len(self.narrow):
            second = by_feature[self.narrow]  # 1 in the second bin
            weights = np.stack([np.ones(len(at)) if c is None else c for c in columns], axis=1)
            first, two = self.starts[self.narrow], self.sizes[self.narrow] == 2
            ends = np.searchsorted(at, np.arange(n_nodes + 1))
            for node in range(n_nodes):
                own = slice(ends[node], ends[node + 1])
                right = np.zeros((len(self.narrow), len(columns)))
                for low in range(own.start, own.stop, BLOCK_ROWS):
                    near = slice(low, min(low + BLOCK_ROWS, own.stop))
                    right += second[:, near].astype(np.float64) @ weights[near]
                found[node, first] = weights[own].sum(axis=0) - right
                found[node, first[two] + 1] = right[two]
        return found


def best_splits(sums: np.ndarray, starts: np.ndarray, usable: np.ndarray, rules: Rules):
    """Best (gain, bin, left sums, all sums) per node, from (node, bin, [g, h, n]) of whole features.

    Without counts, which one row at least does not need: an empty child gains nothing.
    """
    running = np.cumsum(sums, axis=1)
    sizes = np.diff(starts)
    before = np.concatenate([np.zeros_like(running[:, :1]), running], axis=1)[:, starts[:-1]]
    left = running - np.repeat(before, sizes, axis=1)
    whole = left[:, starts[1] - 1]  # any feature's sums add up to those of the node
    right = whole[:, None] - left

    def strength(x):
        weight = x[..., 1] + rules.l2
        return np.divide(x[..., 0] ** 2, weight, out=np.zeros_like(weight), where=weight > 0)

    gain = strength(left) + strength(right) - strength(whole)[:, None]
    for side in (left, right):
        gain[side[..., 1] < rules.min_hessian] = -np.inf
        if side.shape[-1] > 2:
            gain[side[..., 2] < rules.min_rows] = -np.inf
    gain[:, ~usable] = -np.inf
    gain = np.round(gain, 9)  # sums differ in the last digits with the order of the rows
    best = np.argmax(gain, axis=1)
    nodes = np.arange(len(best))
    return gain[nodes, best], best, left[nodes, best], whole


def grow(
    bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, layout: Layout, usable: np.ndarray, rules: Rules,
    by_feature: np.ndarray | None = None,
) -> Tree:
    """The branch of a node whose rows are all here, level by level.

    Of two siblings the one of fewer rows is summed, the sums of the other are what is left of their parent's.
    """
    tree = Tree()
    tree.value[0] = rules.value(g.sum(), h.sum())
    at, here, nodes = np.zeros(len(bins), np.int16), np.arange(len(bins)), [0]
    # without a least hessian, counts tell an empty child from a rest of the subtraction
    columns = [g, h] if rules.min_rows <= 1 and rules.min_hessian >= 1e-6 else [g, h, None]
    by_feature, above, parents = np.ascontiguousarray(bins.T) if by_feature is None else by_feature, None, []
    while nodes and depth < rules.max_depth:
        if above is None:
            sums = layout.sums(by_feature, at, 1, columns)
        else:
            n_rows = np.bincount(at, minlength=len(nodes))
            fewer = np.arange(0, len(nodes), 2) + (n_rows[1::2] < n_rows[::2])
            place = np.full(len(nodes), -1, np.int16)
            place[fewer] = np.arange(len(fewer))
            place = place[at]
            own = np.flatnonzero(place >= 0)
            own = own[np.argsort(place[own], kind="stable")]
            rows = here[own]
            part = layout.sums(by_feature[:, rows], place[own], len(fewer), [c if c is None else c[rows] for c in columns])
            sums = np.empty((len(nodes), *part.shape[1:]))
            sums[fewer], sums[fewer ^ 1] = part, above[parents] - part
        gains, cuts, lefts, wholes = best_splits(sums, layout.starts, usable & ~layout.last, rules)
        following, place, parents = [], np.full((len(nodes), 2), -1, np.int16), []
        for i, node in enumerate(nodes):
            if gains[i] > 0:
                f = layout.feature_of[cuts[i]]
                pair = tree.split(node, int(f), int(cuts[i] - layout.starts[f]), float(gains[i]))
                parents.append(i)
                for side, (child, part) in enumerate(zip(pair, (lefts[i], wholes[i] - lefts[i]))):
                    tree.value[child] = rules.value(part[0], part[1])
                    place[i, side] = len(following)
                    following.append(child)
        above, f = sums, layout.feature_of[cuts]
        goes_right = bins[here, f[at]] > (cuts - layout.starts[f])[at]
        at = place[at, goes_right.astype(np.int8)]
        here, at, nodes, depth = here[at >= 0], at[at >= 0], following, depth + 1
    return tree


# --- blocks -----------------------------------------------------------------------------
def fit_cuts(values: DataFrame, max_bins: int) -> list[list[float]]:
    """Bin borders per feature: quantiles of its values (all of them if there are few)."""
    shares = [i / max_bins for i in range(max_bins + 1)]
    found = (
        values.select(F.posexplode("x").alias("f", "v")).groupBy("f")
        .agg(F.percentile_approx("v", F.array(*map(F.lit, shares)), F.lit(100 * max_bins)).alias("q"))
    )
    rows = {r["f"]: r["q"] for r in found.collect()}  # one row per feature
    return [sorted(set(rows[f]))[:-1] for f in range(len(rows))]


def binned(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bin of every value: values up to a border belong to its bin."""
    out = np.empty(x.shape, np.uint8)
    for f, borders in enumerate(cuts):
        out[:, f] = np.searchsorted(borders, x[:, f], "left")
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def blocks_of(cuts: list[list[float]], base: np.ndarray):
    """Rows (x, label, weight, held) to blocks."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                if waiting and sum(map(len, waiting)) + len(piece) > BLOCK_ROWS:
                    yield pa.concat_batches(waiting)
                    waiting = []
                waiting.append(piece)
        if waiting:
            yield pa.concat_batches(waiting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, piece in enumerate(pieces(batches), TaskContext.get().partitionId() << 32):
            x, label, weight, held = piece.columns
            arrays = [
                binned(_matrix(x), cuts), label.to_numpy().astype(np.int16), weight.to_numpy(),
                held.to_numpy(zero_copy_only=False).astype(np.uint8), np.tile(base, (len(x), 1)),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([block]), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], schema=BLOCK_SCHEMA)

    return run


@dataclass
class Round:
    """What the tasks know of a round: the finished trees since the scores were written, the growing ones, the open nodes."""

    number: int
    finished: list[list[Tree]]
    growing: list[Tree]
    big: list[list[int]]  # open nodes per class whose sums are wanted
    small: list[list[int]]  # open nodes per class whose rows are wanted
    usable: np.ndarray
    loss: bool


class Opened:
    """A block's arrays with the scores of all finished rounds."""

    def __init__(self, row: dict, n_features: int, n_classes: int, finished: list[list[Tree]]):
        self.number = row["block"]
        self.labels = np.frombuffer(row["labels"], np.int16)
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(len(self.labels), n_features)
        self.weights = np.frombuffer(row["weights"])
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.scores = np.frombuffer(row["scores"]).reshape(-1, n_classes).copy()
        for trees in finished:
            for c, tree in enumerate(trees):
                if tree.left[0] or tree.value[0]:
                    self.scores[:, c] += np.array(tree.value)[tree.leaf_of(self.bins)]

    def shares(self) -> np.ndarray:
        e = np.exp(self.scores - self.scores.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def partial_sums(state, layout: Layout, n_classes: int, rules: Rules, row_share: float, seed: int):
    """Blocks to the sums and rows of the open nodes, and to the held-out loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Round = pickle.loads(state.value)
        sums = [np.zeros((len(n), layout.total, 3)) for n in now.big]
        loss = np.zeros(2)

        def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 64]), PART_SCHEMA)], schema=PART_SCHEMA)

        for batch in batches:
            for row in batch.to_pylist():
                block, rows = Opened(row, len(layout.sizes), n_classes, now.finished), []
                p = block.shares()
                if now.loss and block.held.any():
                    own = block.weights[block.held]
                    true = np.maximum(p[block.held, block.labels[block.held]], 1e-15)
                    loss += [-(own * np.log(true)).sum(), own.sum()]
                bins, labels, weights = block.bins, block.labels, block.weights
                used = ~block.held
                if row_share < 1:
                    used &= np.random.default_rng([seed, now.number, block.number]).random(len(used)) < row_share
                if not used.all():
                    bins, labels, weights, p = bins[used], labels[used], weights[used], p[used]
                by_feature = np.ascontiguousarray(bins.T)
                for c, tree in enumerate(now.growing):
                    if not now.big[c] and not now.small[c]:
                        continue
                    g = weights * (p[:, c] - (labels == c))
                    h = rules.hessian_factor * weights * np.maximum(p[:, c] * (1 - p[:, c]), 1e-16)
                    at = tree.leaf_of(bins)
                    if now.big[c]:
                        place = np.full(len(tree.left), -1, np.int16)
                        place[now.big[c]] = np.arange(len(now.big[c]))
                        place = place[at]
                        if len(tree.left) > 1:  # the rows of open nodes, node by node
                            here = np.flatnonzero(place >= 0)
                            here = here[np.argsort(place[here], kind="stable")]
                            found = layout.sums(by_feature[:, here], place[here], len(now.big[c]), [g[here], h[here], None])
                        else:
                            found = layout.sums(by_feature, place, 1, [g, h, None])
                        sums[c] += found
                    for node in now.small[c]:
                        here = np.flatnonzero(at == node)
                        if len(here):
                            rows.append((c, node, -1, np.stack([g[here], h[here]]).tobytes() + bins[here].tobytes()))
                yield from packed(rows)
        rows = []
        for c, nodes in enumerate(now.big):
            for i, node in enumerate(nodes):
                for s, features in enumerate(layout.slices):
                    part = sums[c][i, layout.starts[features[0]] : layout.starts[features[-1] + 1]]
                    if part.any():
                        rows.append((c, node, s, part.tobytes()))
        if now.loss:
            rows.append((LOSS, 0, 0, loss.tobytes()))
        yield from packed(rows)

    return run


def choose(state, layout: Layout, rules: Rules):
    """Parts of one node and slice to its best split, or to its whole branch; a small result row."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, node, piece = (k.as_py() for k in key)
        payloads = (x.as_buffer() for batch in batches for x in batch.column(3))
        now: Round = pickle.loads(state.value)
        if c == LOSS:
            found = {"loss": sum(np.frombuffer(p) for p in payloads).tolist()}
        elif piece < 0:
            width = len(layout.sizes)
            parts = []
            for raw in payloads:
                n = len(raw) // (16 + width)
                parts.append((np.frombuffer(raw, count=2 * n).reshape(2, n), np.frombuffer(raw, np.uint8, offset=16 * n).reshape(n, width)))
            gh, bins = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
            found = {"branch": asdict(grow(bins, *gh, now.growing[c].depth[node], layout, now.usable, rules))}
        else:
            features = layout.slices[piece]
            starts = layout.starts[features[0] : features[-1] + 2]
            span = slice(starts[0], starts[-1])
            sums = sum(np.frombuffer(p) for p in payloads).reshape(1, -1, 3)
            gain, cut, left, whole = best_splits(sums, starts - starts[0], (now.usable & ~layout.last)[span], rules)
            f = layout.feature_of[cut[0] + starts[0]]
            found = {
                "gain": float(gain[0]), "feature": int(f), "cut": int(cut[0] + starts[0] - layout.starts[f]),
                "left": left[0].tolist(), "whole": whole[0].tolist(),
            }
        row = [pa.array([c], pa.int32()), pa.array([node], pa.int32()), pa.array([json.dumps(found)])]
        yield pa.RecordBatch.from_arrays(row, names=["cls", "node", "found"])

    return run


def rescored(state, n_features: int, n_classes: int):
    """Blocks with the scores of all finished rounds written into them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finished = pickle.loads(state.value)
        for batch in batches:
            for row in batch.to_pylist():
                row["scores"] = Opened(row, n_features, n_classes, finished).scores.tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=BLOCK_SCHEMA)

    return run


def whole_fit(n_workers: int, layout: Layout, n_classes: int, rules: Rules, rounds: int, held_out: bool, rates: tuple[float, float], seed: int):
    """All blocks to all trees and held-out losses: every task has all rows, grows the trees of its classes and learns the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        me, width = context.partitionId(), len(layout.sizes)
        rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda r: r["block"])
        blocks = [Opened(row, width, n_classes, []) for row in rows]
        sizes, numbers = [len(b.labels) for b in blocks], [b.number for b in blocks]
        bins, labels, weights, held, scores = (
            np.concatenate([getattr(b, name) for b in blocks]) for name in ("bins", "labels", "weights", "held", "scores")
        )
        rows, blocks = None, None
        every = held.any()
        kept = (bins[~held], labels[~held], weights[~held]) if every else (bins, labels, weights)
        columns = np.ascontiguousarray(kept[0].T)
        all_trees, errors = [], []
        for number in range(rounds + held_out):
            e = np.exp(scores - scores.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            if every:
                own = weights[held]
                loss = -(own * np.log(np.maximum(p[held, labels[held]], 1e-15))).sum()
                if own.sum() > 0:
                    errors.append(float(loss / own.sum()))
            if number == rounds or (held_out and stalled(errors)):
                break
            usable = np.isin(layout.feature_of, chosen_features(seed, number, rates[1], width))
            (own_bins, own_labels, own_weights), by_feature = kept, columns
            near = p[~held] if every else p
            if rates[0] < 1:
                drawn = np.concatenate([np.random.default_rng([seed, number, b]).random(n) < rates[0] for b, n in zip(numbers, sizes)])
                drawn = drawn[~held]
                own_bins, own_labels, own_weights, near = own_bins[drawn], own_labels[drawn], own_weights[drawn], near[drawn]
                by_feature = None
            grown = {}
            for c in range(me, n_classes, n_workers):
                g = own_weights * (near[:, c] - (own_labels == c))
                h = rules.hessian_factor * own_weights * np.maximum(near[:, c] * (1 - near[:, c]), 1e-16)
                grown[c] = asdict(grow(own_bins, g, h, 0, layout, usable, rules, by_feature))
            known = {int(c): Tree(**t) for said in context.allGather(json.dumps(grown)) for c, t in json.loads(said).items()}
            all_trees.append([known[c] for c in range(n_classes)])
            for low in range(0, len(bins), BLOCK_ROWS):
                near = slice(low, low + BLOCK_ROWS)
                for c, tree in known.items():
                    scores[near, c] += np.array(tree.value)[tree.leaf_of(bins[near])]
        if me == 0:
            found = json.dumps({"trees": [[asdict(t) for t in trees] for trees in all_trees], "errors": errors})
            yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])

    return run


def chosen_features(seed: int, number: int, rate: float, n_features: int) -> np.ndarray:
    """The features that a round may split on."""
    draw = np.random.default_rng([seed, number])
    return np.sort(draw.permutation(n_features)[: max(1, round(rate * n_features))])


def places(spark: SparkSession, n: int) -> list[int]:
    """A key for each of ``n`` partitions, by the hash that deals rows to them."""
    found = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    rows = found.groupBy("part").agg(F.min("id").alias("id")).orderBy("part").collect()  # one row per partition
    return [r["id"] for r in rows]


def spread(spark: SparkSession, value) -> Broadcast:
    """Broadcasts ``value`` with its classes, which executors need not have."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


class _Settings(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    stepSize = Param(Params._dummy(), "stepSize", "shrinkage of every tree", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "L2 weight on leaf values", TypeConverters.toFloat)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a child", TypeConverters.toInt)
    minHessian = Param(Params._dummy(), "minHessian", "least hessian sum of a child", TypeConverters.toFloat)
    hessianFactor = Param(Params._dummy(), "hessianFactor", "factor on p (1 - p)", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows of a round", TypeConverters.toFloat)
    columnRate = Param(Params._dummy(), "columnRate", "share of features of a round", TypeConverters.toFloat)
    priors = Param(Params._dummy(), "priors", "start from the class shares", TypeConverters.toBoolean)
    heldOut = Param(Params._dummy(), "heldOut", "a tenth of the rows measures the loss, and its stall ends the fit", TypeConverters.toBoolean)


class HistogramBoosting(Estimator, _Settings, MLWritable):
    """Boosted trees for all classes 0..k-1 under the softmax loss.

    With ``heldOut`` a tenth of the rows (by a hash of the features) measures the loss after every
    round, and the fit ends when ``PATIENCE`` rounds have brought no lower one.
    """

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._setDefault(
            featuresCol="features", labelCol="label", seed=42, stepSize=0.1, maxIter=100, maxDepth=6, maxBins=64, l2=0.0,
            minInstancesPerNode=1, minHessian=0.0, hessianFactor=1.0, subsamplingRate=1.0, columnRate=1.0, priors=False, heldOut=False,
        )
        self._set(**self._input_kwargs)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return DefaultParamsReader(cls)

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        get = self.getOrDefault
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        held = F.pmod(F.xxhash64(self.getFeaturesCol()), F.lit(10)) == 0 if get(self.heldOut) else F.lit(False)
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"),
            weight.alias("weight"), held.alias("held"),
        )
        seen = rows.filter("NOT held").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()
        if not seen:
            raise ValueError("There are no rows to fit")
        n_rows, n_classes = sum(r["n"] for r in seen), max(r["label"] for r in seen) + 1
        base = np.zeros(n_classes)
        if get(self.priors):
            shares = np.full(n_classes, 1e-12)
            for r in seen:
                shares[r["label"]] = max(r["w"], 1e-12)
            base = np.log(shares / shares.sum())
        cuts = fit_cuts(rows.select("x"), get(self.maxBins))
        rules = Rules(
            get(self.maxDepth), get(self.l2), get(self.minInstancesPerNode), get(self.minHessian), get(self.stepSize), get(self.hessianFactor)
        )
        # as many parts as cores have work, more where the rows need them
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        parts = max(min(cores, -(-n_rows // TASK_ROWS)), -(-n_rows * (len(cuts) + 8 * n_classes) // PARTITION_BYTES))
        blocks = rows.repartition(parts).mapInArrow(blocks_of(cuts, base), BLOCK_TYPE)
        trees, errors = self._rounds(blocks, parts, Layout([len(c) + 1 for c in cuts]), n_rows, n_classes, rules)
        model = BoostedModel(trees=trees, cuts=cuts, base=base.tolist(), errors=errors)
        return self._copyValues(model)

    def _rounds(self, blocks: DataFrame, parts: int, layout: Layout, n_rows: int, n_classes: int, rules: Rules):
        get, spark = self.getOrDefault, blocks.sparkSession
        seed, held, row_share = get(self.seed), get(self.heldOut), get(self.subsamplingRate)
        # every job below is small and has no plan to improve at run time
        session = spark.newSession()
        session.conf.set("spark.sql.adaptive.enabled", "false")

        def stored(df: DataFrame) -> DataFrame:
            path = scratch_path(spark, "boosting-blocks")
            df.write.parquet(path)
            return session.read.parquet(path).coalesce(parts).persist()

        blocks = stored(blocks)
        dynamic = spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true"
        if not dynamic and n_rows * (len(layout.sizes) + 8 * n_classes) <= PARTITION_BYTES:
            return self._whole(blocks, layout, n_classes, rules)
        all_trees: list[list[Tree]] = []
        pending: list[list[Tree]] = []
        errors: list[float] = []
        n_features = len(layout.sizes)
        for number in range(get(self.maxIter) + held):
            last = number == get(self.maxIter)  # only the loss of the last trees is wanted
            usable = np.isin(layout.feature_of, chosen_features(seed, number, get(self.columnRate), n_features))
            trees = [Tree() for _ in range(n_classes)]
            sizes = [{0: n_rows} for _ in trees]
            while True:
                opened = [[] if last else [n for n in sizes[c]] for c in range(n_classes)]
                big = [[n for n in nodes if sizes[c][n] > NODE_ROWS] for c, nodes in enumerate(opened)]
                small = [[n for n in nodes if sizes[c][n] <= NODE_ROWS] for c, nodes in enumerate(opened)]
                measured = held and len(errors) < len(all_trees) + 1
                state = spread(spark, Round(number, pending, trees, big, small, usable, measured))
                sums = blocks.mapInArrow(partial_sums(state, layout, n_classes, rules, row_share, seed), PART_TYPE)
                dealt = sums.repartition(max(2 * n_classes, parts), "cls", "node", "slice")
                answers = dealt.groupBy("cls", "node", "slice").applyInArrow(
                    choose(state, layout, rules), "cls int, node int, found string"
                ).collect()  # a row per class, node and slice of features
                state.destroy()
                best: dict[tuple[int, int], dict] = {}
                for r in answers:
                    found = json.loads(r["found"])
                    if r["cls"] == LOSS:
                        if measured and found["loss"][1] > 0:
                            errors.append(found["loss"][0] / found["loss"][1])
                        continue
                    key = (r["cls"], r["node"])
                    if "branch" in found:
                        trees[r["cls"]].graft(r["node"], Tree(**found["branch"]))
                    elif key not in best or (-found["gain"], found["feature"]) < (-best[key]["gain"], best[key]["feature"]):
                        best[key] = found
                if last or (measured and stalled(errors)):
                    blocks.unpersist()
                    return all_trees, errors
                sizes = [{} for _ in trees]
                for (c, node), found in sorted(best.items()):
                    tree, whole, left = trees[c], np.array(found["whole"]), np.array(found["left"])
                    tree.value[node] = rules.value(whole[0], whole[1])
                    if found["gain"] > 0 and tree.depth[node] < rules.max_depth:
                        pair = tree.split(node, found["feature"], found["cut"], found["gain"])
                        for child, part in zip(pair, (left, whole - left)):
                            tree.value[child] = rules.value(part[0], part[1])
                            if tree.depth[child] < rules.max_depth:
                                sizes[c][child] = int(part[2])
                if not any(sizes):
                    break
            all_trees.append(trees)
            pending = [*pending, trees]
            if len(pending) == STORE_ROUNDS:
                state = spread(spark, pending)
                newer = stored(blocks.mapInArrow(rescored(state, n_features, n_classes), BLOCK_TYPE))
                blocks.unpersist()
                blocks, pending = newer, []
        blocks.unpersist()
        return all_trees, errors


    def _whole(self, blocks: DataFrame, layout: Layout, n_classes: int, rules: Rules):
        """The fit as one job, whose tasks run side by side to its end."""
        get, spark = self.getOrDefault, blocks.sparkSession
        workers = places(spark, min(n_classes, spark.sparkContext.defaultParallelism))
        dealt = blocks.select("*", F.explode(F.array(*[F.lit(w).cast("long") for w in workers])).alias("worker"))
        fit = whole_fit(
            len(workers), layout, n_classes, rules, get(self.maxIter), get(self.heldOut),
            (get(self.subsamplingRate), get(self.columnRate)), get(self.seed),
        )
        answer = dealt.repartition(len(workers), "worker").drop("worker").mapInArrow(fit, "found string", barrier=True).collect()
        blocks.unpersist()
        found = json.loads(answer[0]["found"])
        return [[Tree(**t) for t in trees] for trees in found["trees"]], found["errors"]


class _ModelReader(MLReader):
    def load(self, path: str) -> BoostedModel:
        whole = json.loads(self.sparkSession.read.text(f"{path}/model").first()[0])
        trees = [[Tree(**t) for t in row] for row in whole.pop("trees")]
        model = BoostedModel(trees=trees, **{k: whole[k] for k in ("cuts", "base", "errors")})
        return model._set(**whole["columns"])


class _ModelWriter(MLWriter):
    def __init__(self, model: BoostedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        whole = {
            "trees": [[asdict(t) for t in row] for row in m.trees], "cuts": m.cuts, "base": m.base, "errors": m.errors,
            "columns": {"featuresCol": m.getFeaturesCol(), "labelCol": m.getLabelCol()},
        }
        self.sparkSession.createDataFrame([(json.dumps(whole),)], "value string").write.text(f"{path}/model")


class BoostedModel(Model, _Settings, MLWritable, MLReadable):
    """Trees of every round and class; ``errors`` are the held-out losses before every round and after the last."""

    def __init__(self, trees=(), cuts=(), base=(), errors=()):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self.trees, self.cuts, self.base, self.errors = list(trees), list(cuts), list(base), list(errors)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    @property
    def n_rounds(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Gain per feature as shares."""
        gains = np.zeros(len(self.cuts))
        for trees in self.trees:
            for tree in trees:
                np.add.at(gains, tree.feature, np.where(np.array(tree.left) > 0, tree.gain, 0.0))
        return Vectors.dense(gains / (gains.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = spread(dataset.sparkSession, (self.trees, self.cuts, self.base))

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def shares(x: pa.Array) -> pa.Array:
            trees, cuts, base = pickle.loads(state.value)
            bins = binned(_matrix(x), cuts)
            scores = np.tile(np.array(base), (len(bins), 1))
            for row in trees:
                for c, tree in enumerate(row):
                    scores[:, c] += np.array(tree.value)[tree.leaf_of(bins)]
            e = np.exp(scores - scores.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            offsets = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))

        found = dataset.withColumn("_p", shares(vector_to_array(self.getFeaturesCol())))
        best = F.array_position("_p", F.array_max("_p")) - 1
        return found.withColumns({"probability": array_to_vector("_p"), "prediction": best.cast("double")}).drop("_p")
