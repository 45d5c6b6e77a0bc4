"""Boosted trees of all folds and learners grown side by side.

Inputs are cut into bins once. A pass over the rows adds up, for every model still growing, the
gradient and curvature of the log-loss by node, input and bin; the driver picks the splits. The
number of passes is that of one model, however many folds and learners there are, and what is
added up does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.functions.skew import stable
from ebbtide.functions.workers import find_package
from ebbtide.ml.shapley import Tree

BINS = 32
LEAST_CURVATURE = 1.0  # of the rows in each child
LEAST_GAIN = 1e-9
STORED_EVERY = 5       # trees after which the rows' margins are written again
CHUNK_ROWS = 20_000    # rows that a task works on at once
# Settings that a fit understands, by Spark's names; rounds is how many trees a model
# may go on without a better loss on the rows it does not learn from.
SETTINGS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.67,
            "featureSubsetStrategy": "0.55", "rounds": 10}


# ---- a fitted model -------------------------------------------------------

@dataclass
class Nodes:
    """A tree as arrays: inner nodes have a feature, leaves (-1) a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: float) -> tuple[int, int]:
        left, right = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = left, right
        for column, empty in ((self.feature, -1), (self.cut, 0.0), (self.left, 0),
                              (self.right, 0), (self.value, 0.0)):
            column += [empty, empty]
        return left, right

    def arrays(self, kind=np.float64) -> Steps:
        """What ``places`` reads; a leaf is followed by itself. Cuts are of the inputs' kind."""
        feature = np.array(self.feature, np.intp)
        own, leaf = np.arange(len(feature)), feature < 0
        after = np.stack([np.where(leaf, own, self.left), np.where(leaf, own, self.right)], axis=1)
        depth, level = 0, [0]
        while inner := [n for n in level if not leaf[n]]:
            depth, level = depth + 1, after[inner].ravel().tolist()
        return Steps(np.where(leaf, 0, feature), np.array(self.cut).astype(kind),
                     after.ravel().astype(np.intp), np.array(self.value), depth)


@dataclass
class Steps:
    """A tree as ``places`` reads it: node n is followed by after[2 n] or after[2 n + 1]."""

    feature: np.ndarray
    cut: np.ndarray
    after: np.ndarray
    value: np.ndarray
    depth: int


def places(tree: Steps, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The leaf of each row; a row goes left if its value is at most the cut.

    x is the flat matrix, starts are the places in it at which the rows begin.
    """
    at = np.zeros(len(starts), np.intp)
    for _ in range(tree.depth):
        value = x.take(starts + tree.feature.take(at))
        at = tree.after.take(2 * at + ~(value <= tree.cut.take(at)))
    return at


def row_starts(x: np.ndarray) -> np.ndarray:
    return np.arange(len(x)) * x.shape[1]


@dataclass
class BoostedTrees:
    """Log-odds as a start plus the leaf values of trees; gains tell how much inputs helped."""

    vector: str
    start: float
    depth: int
    trees: list[Nodes]
    gains: list[float]

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, flat, starts = np.full(len(x), self.start), x.ravel(), row_starts(x)
        for tree in (t.arrays() for t in self.trees):
            total += tree.value.take(places(tree, flat, starts))
        return total

    def as_trees(self) -> list[Tree]:
        """The trees as their explanations read them; the start is a tree of one leaf."""
        out = [Tree({0: self.start})]
        for t in self.trees:
            out.append(Tree({i: (f, t.cut[i], t.left[i], t.right[i]) if f >= 0 else t.value[i]
                             for i, f in enumerate(t.feature)}))
        return out

    def plain(self) -> dict:
        return {"vector": self.vector, "start": self.start, "depth": self.depth,
                "gains": self.gains,
                "trees": [[t.feature, t.cut, t.left, t.right, t.value] for t in self.trees]}

    @classmethod
    def of_plain(cls, plain: dict) -> BoostedTrees:
        return cls(plain["vector"], plain["start"], plain["depth"],
                   [Nodes(*t) for t in plain["trees"]], plain["gains"])


def chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def probabilities(models: Sequence[BoostedTrees]) -> Column:
    """An array of the models' probabilities of their vector, from one call for each batch."""
    def score(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        found = np.stack([chance(m.margins(rows)) for m in models], axis=1)
        return pa.ListArray.from_arrays(
            np.arange(len(x) + 1, dtype=np.int32) * len(models), pa.array(found.ravel()))

    return F.arrow_udf(score, "array<double>")(vector_to_array(models[0].vector))


# ---- growing --------------------------------------------------------------

def uniform(seed: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each seed and salt, the same wherever it is worked out."""
    with np.errstate(over="ignore"):
        z = seed.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(salt + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


@dataclass
class Work:
    """What a task needs of a model under way: trees that stored margins lack, and its newest."""

    number: int
    fold: int
    rate: float
    salt: int
    lacking: list[Steps]
    tree: Steps
    frontier: list[int]
    chosen: np.ndarray

    def margins(self, bins: np.ndarray, starts: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """Of the rows that start there, in the flat matrix of bins."""
        total = stored.copy()
        for tree in self.lacking:
            total += tree.value.take(places(tree, bins, starts))
        return total

    def sums(self, chunk: Chunk, judged: bool) -> np.ndarray:
        """Loss and rows of the left-out fold, then gradient and curvature by input, node, bin.

        Only the rows that count, sampled ones in a node of the frontier, are followed further.
        """
        bins, starts = chunk.bins, chunk.starts
        stored = chunk.margins[:, self.number]
        out, held = np.zeros(2), chunk.fold == self.fold
        if judged:
            rows = np.flatnonzero(held)
            margin = self.margins(bins, starts[rows], stored[rows])
            out[:] = np.logaddexp(0, margin).sum() - chunk.label[rows] @ margin, len(rows)
        use = np.flatnonzero(~held & (uniform(chunk.seed, self.salt) < self.rate))
        spot = np.full(len(self.tree.feature), -1)
        spot[self.frontier] = np.arange(len(self.frontier))
        at = spot.take(places(self.tree, bins, starts[use]))
        if (at < 0).any():
            use, at = use[at >= 0], at[at >= 0]
        label = chunk.label[use]
        p = chance(self.margins(bins, starts[use], stored[use]))
        gradient, curvature = p - label, p * (1 - p)
        base, size = at * BINS, len(self.frontier) * BINS
        parts = []
        for c in self.chosen:
            place = base + chunk.columns[c].take(use)
            parts += [np.bincount(place, gradient, size), np.bincount(place, curvature, size)]
        return np.concatenate([out, *parts])


@dataclass
class Growing:
    """One model under way: a learner's inputs without the rows of one fold.

    Features of its trees are columns of the binned matrix, their cuts are bins.
    """

    number: int
    learner: str
    vector: str
    fold: int
    columns: np.ndarray
    cuts: list[np.ndarray]
    settings: dict
    start: float
    trees: list[Nodes] = field(default_factory=list)
    gains: dict[int, float] = field(default_factory=dict)
    done: bool = False
    best: float = np.inf
    best_trees: int = 0
    tree: Nodes | None = None
    frontier: list[int] = field(default_factory=list)
    chosen: np.ndarray | None = None
    stored: int = 0  # trees that the stored margins hold

    def begin(self) -> None:
        draw = np.random.default_rng([self.number, len(self.trees)])
        share = float(self.settings["featureSubsetStrategy"])
        size = max(1, int(np.ceil(share * len(self.columns))))
        self.chosen = np.sort(draw.choice(self.columns, size, replace=False))
        self.tree, self.frontier = Nodes(), [0]

    def work(self) -> Work:
        return Work(
            self.number, self.fold, self.settings["subsamplingRate"],
            self.number * 10_000 + len(self.trees),
            [t.arrays(np.uint8) for t in self.trees[self.stored:]], self.tree.arrays(np.uint8),
            self.frontier, self.chosen)

    def judge(self, loss: float, rows: float) -> None:
        """Ends the model once its left-out fold has not gained for some trees; the best stays."""
        trees = len(self.trees)
        if not rows:
            self.best_trees = trees
        elif trees and loss / rows < self.best:
            self.best, self.best_trees = loss / rows, trees
        self.done = trees >= self.settings["maxIter"] or (
            rows > 0 and trees - self.best_trees >= self.settings["rounds"])

    def grow(self, flat: np.ndarray, last: bool) -> None:
        """Splits the nodes of the frontier where that helps; the tree ends with the last level."""
        grid = flat.reshape(len(self.chosen), 2, len(self.frontier), BINS)
        step, grown = self.settings["stepSize"], []
        for spot, node in enumerate(self.frontier):
            g, h = grid[:, 0, spot], grid[:, 1, spot]
            total_g, total_h = g[0].sum(), h[0].sum()
            if node == 0 and total_h > 0:
                self.tree.value[0] = -step * total_g / total_h
            left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            fine = (left_h >= LEAST_CURVATURE) & (right_h >= LEAST_CURVATURE)
            if not fine.any():
                continue
            gain = np.full(fine.shape, -np.inf)
            gain[fine] = left_g[fine] ** 2 / left_h[fine] + right_g[fine] ** 2 / right_h[fine]
            best = np.unravel_index(np.argmax(gain), gain.shape)
            better = gain[best] - total_g ** 2 / total_h
            if not better > LEAST_GAIN:
                continue
            column = int(self.chosen[best[0]])
            self.gains[column] = self.gains.get(column, 0.0) + float(better)
            left, right = self.tree.split(node, column, float(best[1]))
            self.tree.value[left] = float(-step * left_g[best] / left_h[best])
            self.tree.value[right] = float(-step * right_g[best] / right_h[best])
            grown += [left, right]
        self.frontier = [] if last else grown
        if not self.frontier:
            self.trees.append(self.tree)

    def model(self) -> BoostedTrees:
        """With cuts as values of the inputs, which are numbered as the learner has them."""
        place = {int(c): i for i, c in enumerate(self.columns)}
        trees = []
        for tree in self.trees[:self.best_trees]:
            feature = [place[f] if f >= 0 else -1 for f in tree.feature]
            cut = [float(self.cuts[f][int(c)]) if f >= 0 else 0.0
                   for f, c in zip(tree.feature, tree.cut)]
            trees.append(Nodes(feature, cut, tree.left, tree.right, tree.value))
        total = sum(self.gains.values()) or 1.0
        return BoostedTrees(self.vector, self.start, self.settings["maxDepth"], trees,
                            [self.gains.get(int(c), 0.0) / total for c in self.columns])


def bin_cuts(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Up to BINS - 1 cuts of each input, at its quantiles over all rows."""
    at = [i / BINS for i in range(1, BINS)]
    aggregates = [F.percentile_approx(F.get("_x", F.lit(i)), at, 50 * BINS).alias(f"c{i}")
                  for i in range(width)]
    tops = [F.max(F.get("_x", F.lit(i))).alias(f"t{i}") for i in range(width)]
    row = rows.agg(*aggregates, *tops).first()
    cuts = []
    for i in range(width):
        found = np.unique(np.array(row[f"c{i}"] or [], np.float64))
        cuts.append(found[found < row[f"t{i}"]] if len(found) else found)
    return cuts


def binned(rows: DataFrame, cuts: Sequence[np.ndarray], starts: Sequence[float]) -> DataFrame:
    """(bins, label, fold, seed, margins), stored: a byte an input and a double a model."""
    starts = np.array(starts, np.float64)

    def run(items):
        for batch in items:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            x = x.reshape(-1, len(cuts))
            bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [_bytes(bins.astype(np.uint8)), *batch.columns[1:],
                 _bytes(np.tile(starts, (len(x), 1)))],
                names=["bins", "label", "fold", "seed", "margins"])

    return stable(rows.mapInArrow(
        run, "bins binary, label double, fold int, seed long, margins binary"))


def _bytes(rows: np.ndarray) -> pa.Array:
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(size), len(rows), [
        None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Binary values of equal length as the rows of a matrix."""
    starts = np.frombuffer(column.buffers()[1], np.int32)[column.offset:][:len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[starts[0]:starts[-1]]
    return data.view(kind).reshape(len(column), -1)


@dataclass
class Chunk:
    """Binned rows of a task: the bins flat, where rows start in them, and by input."""

    bins: np.ndarray
    starts: np.ndarray
    columns: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    seed: np.ndarray
    margins: np.ndarray


def _chunk(batch: pa.RecordBatch) -> Chunk:
    label, fold, seed = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
    bins = _matrix(batch.column(0), np.uint8)
    return Chunk(bins.ravel(), row_starts(bins), np.ascontiguousarray(bins.T), label, fold, seed,
                 _matrix(batch.column(4), np.float64))


def _joined(items: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches put together up to CHUNK_ROWS rows, so that calls for each model are few."""
    held, rows = [], 0
    for batch in items:
        held.append(batch)
        rows += len(batch)
        if rows >= CHUNK_ROWS:
            yield _one(held)
            held, rows = [], 0
    if rows:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def histogram_pass(rows: DataFrame, models: Sequence[Growing], judged: bool) -> dict:
    """Model number to its sums over all rows; a task adds up its own first."""
    work = [m.work() for m in models]

    def run(items):
        total = {}
        for chunk in map(_chunk, _joined(items)):
            for m in work:
                total[m.number] = total.get(m.number, 0.0) + m.sums(chunk, judged)
        if total:
            flat = list(total.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.ListArray.from_arrays(
                    np.cumsum([0, *map(len, flat)]).astype(np.int32),
                    pa.array(np.concatenate(flat)))],
                names=["model", "sums"])

    parts = rows.mapInArrow(run, "model int, sums array<double>").groupBy("model").agg(
        Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return {r["model"]: r["sums"].toArray() for r in parts.collect()}


def with_margins(rows: DataFrame, models: Sequence[Growing]) -> DataFrame:
    """The rows with the margins of all trees so far, stored."""
    for m in models:
        m.begin()
    work = [m.work() for m in models]

    def run(items):
        for batch in items:
            chunk = _chunk(batch)
            margins = chunk.margins.copy()
            for m in work:
                margins[:, m.number] = m.margins(
                    chunk.bins, chunk.starts, margins[:, m.number])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], _bytes(margins)], names=batch.schema.names)

    out = stable(rows.mapInArrow(run, rows.schema))
    for m in models:
        m.stored = len(m.trees)
    return out


def fit_folds(public: DataFrame, learners: Sequence[tuple[str, str, dict]], label: str, fold: str,
              folds: int, *, seed: Column) -> tuple[dict[str, list[BoostedTrees]], int]:
    """A model per learner and fold, fitted on the other folds' rows, and the number of passes.

    learners are (name, vector column, settings). A model stops when its own fold, which it does not
    learn from, gains no more. seed is a column that tells rows apart; samples follow from it.
    """
    find_package(public.sparkSession)
    vectors = [vector_to_array(vector) for _, vector, _ in learners]
    rows = public.select(
        F.concat(*vectors).alias("_x"), F.col(label).cast("double").alias("label"),
        F.col(fold).cast("int").alias("fold"), seed.cast("long").alias("seed"))
    sizes = public.select(*[F.size(v).alias(f"n{i}") for i, v in enumerate(vectors)]).first()
    if sizes is None:
        raise ValueError("no rows to learn from")
    ends = np.cumsum(list(sizes))
    counts = {r["fold"]: (r["n"], r["y"]) for r in rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("y")).collect()}
    n, y = (sum(c[i] for c in counts.values()) for i in (0, 1))
    cuts = bin_cuts(rows, int(ends[-1]))
    models = []
    for (name, vector, settings), end, size in zip(learners, ends, sizes):
        for i in range(folds):
            held = counts.get(i, (0, 0))
            share = (y - held[1] + 0.5) / (n - held[0] + 1.0)
            models.append(Growing(
                len(models), name, vector, i, np.arange(end - size, end), cuts,
                {**SETTINGS, **settings}, float(np.log(share / (1 - share)))))
    table = binned(rows, cuts, [m.start for m in models])
    passes = 2
    trees = 0
    while True:
        active = [m for m in models if not m.done]
        for m in active:
            m.begin()
        level, growing = 0, active
        while growing:
            found = histogram_pass(table, growing, judged=level == 0)
            passes += 1
            for m in growing:
                sums = found[m.number]
                if level == 0:
                    m.judge(sums[0], sums[1])
                if not m.done:
                    m.grow(sums[2:], last=level + 1 >= m.settings["maxDepth"])
            level += 1
            growing = [m for m in growing if not m.done and m.frontier]
        active = [m for m in active if not m.done]
        if not active:
            break
        trees += 1
        if trees % STORED_EVERY == 0:
            table = with_margins(table, active)
            passes += 1
    out: dict[str, list[BoostedTrees]] = {name: [] for name, _, _ in learners}
    for m in models:
        out[m.learner].append(m.model())
    return out, passes
