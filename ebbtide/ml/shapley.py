"""Exact Shapley values of tree ensembles against a whole background table.

A leaf is reached if every feature on its path lies inside its bounds. Of a row and a background
row, features that both satisfy do not matter, a leaf that some feature of neither satisfies
is never reached, and otherwise the leaf pays each feature that only the row (p of them) or only
the background row (q of them) satisfies its value times (p - 1)! q! / (p + q)! or, taken away,
p! (q - 1)! / (p + q)!. What a background row satisfies of a leaf is a set of bits, so the
background is counted once per leaf and bit set, and the work grows with rows plus background
rows, not with their product. Leaves share their bounds, so each distinct bound is tried once on a
block of rows. The background keeps a bit a row: rows that satisfy all of some slots are counted by
ANDs, and what satisfies these and no others follows from the totals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache, cached_property
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.functions.skew import staged_folder
from ebbtide.functions.workers import find_package
from ebbtide.ml.prepare import feature_of

CELLS = 1 << 25    # rows times distinct bounds that a task looks at together for values
BLOCK_ROWS = 32768  # rows of the background that a task looks at together, unless they are wide
BLOCK_BYTES = 1 << 26
FEW_SLOTS = 6      # up to so many features a leaf has a place for each bit set


@dataclass
class Tree:
    """A weighted tree as nodes: (feature, threshold, left, right), or a value at a leaf."""

    nodes: dict[int, tuple[int, float, int, int] | float]
    weight: float = 1.0


@dataclass
class Leaves:
    """Leaves of all trees: weighted values, and for each the bounds of up to K inputs.

    A bound belongs to a slot, one for each feature of the leaf, so that a feature and its
    indicator of missing values are one. Missing bounds have no input (-1).
    """

    features: list[str]
    value: np.ndarray    # (L,)
    column: np.ndarray   # (L, K) input
    low: np.ndarray      # (L, K) the input is greater than low
    high: np.ndarray     # (L, K) and at most high
    slot: np.ndarray     # (L, K)
    feature: np.ndarray  # (L, D) feature of a slot, -1 beyond the leaf's last

    @cached_property
    def slots(self) -> np.ndarray:
        """How many features each leaf has."""
        return (self.feature >= 0).sum(axis=1).astype(np.int64)

    @property
    def full(self) -> np.ndarray:
        """The bit set of all slots of each leaf."""
        return (1 << self.slots) - 1

    @cached_property
    def kind(self) -> type:
        """Of the bit sets: a byte if that is enough."""
        return np.uint8 if self.feature.shape[1] <= 8 else np.int64

    @cached_property
    def bounds(self) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """The distinct (column, low, high), and of each leaf the numbers and slots of its own."""
        used = self.column >= 0
        each = np.stack([self.column[used], self.low[used], self.high[used]], axis=1)
        distinct, number = np.unique(each, axis=0, return_inverse=True)
        own: list[list[tuple[int, int]]] = [[] for _ in self.value]
        for leaf, n, slot in zip(np.nonzero(used)[0].tolist(), number.ravel().tolist(),
                                 self.slot[used].tolist()):
            own[leaf].append((n, slot))
        return distinct, [sorted(pairs, key=lambda pair: pair[1]) for pairs in own]

    def broken(self, inputs: np.ndarray) -> Iterator[np.ndarray]:
        """For each distinct bound, which rows do not keep it."""
        columns = np.ascontiguousarray(inputs.T)
        for column, low, high in self.bounds[0].tolist():
            x = columns[int(column)]
            yield x <= low if np.isinf(high) else (x <= low) | ~(x <= high)

    def sets(self, inputs: np.ndarray, only: Sequence[int] | None = None
             ) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, the slots of it whose bounds each row keeps, as bits), one leaf after the other."""
        distinct, own = self.bounds
        broken = np.empty((len(distinct), len(inputs)), self.kind)
        for n, rows in enumerate(self.broken(inputs)):
            broken[n] = rows
        full = self.full.tolist()
        for leaf in range(len(own)) if only is None else only:
            bits = np.full(len(inputs), full[leaf], self.kind)
            for n, slot in own[leaf]:
                bits &= ~(broken[n] << self.kind(slot))
            yield leaf, bits

    def satisfied(self, inputs: np.ndarray) -> np.ndarray:
        """(rows, L): the slots of each leaf whose bounds the row keeps, as bits."""
        out = np.zeros((len(inputs), len(self.value)), np.int64)
        for leaf, bits in self.sets(inputs):
            out[:, leaf] = bits
        return out

    def total(self, inputs: np.ndarray) -> np.ndarray:
        """The ensemble's value of each row."""
        return (self.satisfied(inputs) == self.full) @ self.value


def leaves_of(trees: Sequence[Tree], inputs: Sequence[str]) -> Leaves:
    """Leaves with the bounds of their paths; inputs name the columns that features number."""
    features = list(dict.fromkeys(map(feature_of, inputs)))
    owner = [features.index(feature_of(name)) for name in inputs]
    found = []
    for tree in trees:
        waiting = [(0, {})]
        while waiting:
            number, bounds = waiting.pop()
            node = tree.nodes[number]
            if not isinstance(node, tuple):
                found.append((node * tree.weight, bounds))
                continue
            column, threshold, left, right = node
            low, high = bounds.get(column, (-np.inf, np.inf))
            waiting.append((left, {**bounds, column: (low, min(high, threshold))}))
            waiting.append((right, {**bounds, column: (max(low, threshold), high)}))
    most = max((len(bounds) for _, bounds in found), default=0)
    shape = len(found), most
    column, slot = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
    feature = np.full(shape, -1, np.int64)
    low, high = np.full(shape, -np.inf), np.full(shape, np.inf)
    for leaf, (_, bounds) in enumerate(found):
        own = list(dict.fromkeys(owner[c] for c in bounds))
        feature[leaf, :len(own)] = own
        for k, (c, (least, most_)) in enumerate(bounds.items()):
            column[leaf, k], slot[leaf, k] = c, own.index(owner[c])
            low[leaf, k], high[leaf, k] = least, most_
    return Leaves(features, np.array([v for v, _ in found]), column, low, high, slot, feature)


@dataclass
class Background:
    """How many background rows satisfy which bits of each leaf, in the order of the leaves."""

    start: np.ndarray  # (L + 1,) where a leaf's bit sets begin
    bits: np.ndarray
    count: np.ndarray
    rows: int

    @classmethod
    def of(cls, leaf: np.ndarray, bits: np.ndarray, count: np.ndarray,
           leaves: int) -> Background:
        order = np.lexsort((bits, leaf))
        leaf, bits, count = leaf[order], bits[order], count[order]
        start = np.searchsorted(leaf, np.arange(leaves + 1))
        return cls(start, bits, count, int(count[:start[1]].sum()) if leaves else 0)

    def mean(self, leaves: Leaves) -> float:
        """The ensemble's mean value over the background."""
        leaf = np.repeat(np.arange(len(leaves.value)), np.diff(self.start))
        reached = self.bits == leaves.full[leaf]
        return float((leaves.value[leaf] * self.count * reached).sum() / self.rows)


class Tally:
    """Rows counted by leaf and bit set: in place for leaves of few features, else by sorting.

    A place holds the rows that satisfy at least its slots.
    """

    def __init__(self, leaves: Leaves):
        self.leaves, few = leaves, leaves.slots <= FEW_SLOTS
        self.few, self.many = np.flatnonzero(few).tolist(), np.flatnonzero(~few).tolist()
        self.start = np.concatenate([[0], np.cumsum(np.where(few, 1 << leaves.slots, 0))])
        self.count = np.zeros(self.start[-1], np.int64)

    def add(self, inputs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Adds rows; gives (leaf, bits, count) of these rows for leaves without places."""
        distinct, own = self.leaves.bounds
        words = -(-len(inputs) // 64)

        def packed(rows: np.ndarray) -> np.ndarray:
            out = np.zeros(words * 8, np.uint8)
            out[:-(-len(rows) // 8)] = np.packbits(rows)
            return out.view(np.uint64)

        kept = [packed(~rows) for rows in self.leaves.broken(inputs)]
        sets = np.empty((1 << FEW_SLOTS, words), np.uint64)
        sets[0] = packed(np.ones(len(inputs), bool))
        start, slots = self.start.tolist(), self.leaves.slots.tolist()
        for leaf in self.few:
            last = -1
            for n, slot in own[leaf]:
                half = 1 << slot
                np.bitwise_and(sets[half:2 * half] if slot == last else sets[:half], kept[n],
                               out=sets[half:2 * half])
                last = slot
            self.count[start[leaf]:start[leaf + 1]] += np.bitwise_count(
                sets[:1 << slots[leaf]]).sum(axis=1, dtype=np.int64)
        if self.many:
            for leaf, bits in self.leaves.sets(inputs, self.many):
                found, count = np.unique(bits, return_counts=True)
                yield np.full(len(found), leaf), found, count

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, bits, count) of all rows for the leaves that have places."""
        exact = np.zeros_like(self.count)
        slots = self.leaves.slots
        for size in np.unique(slots[self.few]).tolist():
            places = self.start[:-1][slots == size][:, None] + np.arange(1 << size)
            part = self.count[places]
            for slot in range(size):
                by = part.reshape(len(part), -1, 2, 1 << slot)
                by[:, :, 0] -= by[:, :, 1]
            exact[places] = part
        at = np.flatnonzero(exact)
        leaf = np.searchsorted(self.start, at, side="right") - 1
        return leaf, at - self.start[leaf], exact[at]


def counted(leaves: Leaves, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, bits, count) over the given rows."""
    tally = Tally(leaves)
    parts = [*tally.add(inputs), tally.counts()]
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*parts))


def payments(mine: np.ndarray, others: np.ndarray, slots: int) -> np.ndarray:
    """(others, slots, mine): what a leaf of value 1 pays a row that satisfies mine, against one
    that satisfies others, for the feature of each slot."""
    mine, others = mine.astype(np.int64)[None, :], others.astype(np.int64)[:, None]
    only, instead = mine & ~others, others & ~mine
    p, q = np.bitwise_count(only), np.bitwise_count(instead)
    live = (mine | others) == (1 << slots) - 1
    orders = np.array([float(factorial(n)) for n in range(slots + 1)])
    share = live / orders[p + q]
    gain = share * orders[np.maximum(p, 1) - 1] * orders[q]
    loss = share * orders[p] * orders[np.maximum(q, 1) - 1]
    return np.stack([np.where(only >> slot & 1, gain, 0) - np.where(instead >> slot & 1, loss, 0)
                     for slot in range(slots)], axis=1)


@cache
def all_payments(slots: int) -> np.ndarray:
    """The payments between any two bit sets, (others, slots times mine)."""
    every = np.arange(1 << slots)
    return payments(every, every, slots).reshape(len(every), -1)


def values_of(leaves: Leaves, background: Background, inputs: np.ndarray) -> np.ndarray:
    """(rows, features): Shapley values. A leaf is worked out once for each bit set of it."""
    out = np.zeros((len(leaves.features), len(inputs)))
    start, slots = background.start.tolist(), leaves.slots.tolist()
    worth, features = (leaves.value / background.rows).tolist(), leaves.feature.tolist()
    for leaf, mine in leaves.sets(inputs):
        size, entries = slots[leaf], slice(start[leaf], start[leaf + 1])
        if not size:
            continue
        others, share = background.bits[entries], background.count[entries] * worth[leaf]
        if size <= FEW_SLOTS:
            paid = (share @ all_payments(size)[others]).reshape(size, -1)
        else:
            own, mine = np.unique(mine, return_inverse=True)
            paid = np.tensordot(share, payments(own, others, size), 1)
        for feature, pay in zip(features[leaf], paid):
            out[feature] += pay.take(mine)
    return out.T


# ---- over tables ----------------------------------------------------------

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _joined(items: Iterable[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The first columns of batches put together, so that there are many rows for each leaf."""
    most, held, rows = min(BLOCK_ROWS, max(1, BLOCK_BYTES // (8 * width))), [], 0
    for batch in items:
        held.append(_matrix(batch.column(0), width))
        rows += len(batch)
        if rows >= most:
            yield np.concatenate(held)
            held, rows = [], 0
    if rows:
        yield np.concatenate(held)


def background_of(leaves: Leaves, rows: DataFrame, inputs: Sequence[str]) -> Background:
    """Counts all rows. Tasks add up their own; to the driver come at most, for each leaf, two
    to the number of features on its path."""
    find_package(rows.sparkSession)

    def table(parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)],
            names=["leaf", "bits", "n"])

    def run(items):
        tally = Tally(leaves)
        for x in _joined(items, len(inputs)):
            if rest := list(tally.add(x)):
                yield table(rest)
        yield table([tally.counts()])

    counts = (rows.select(_array(inputs)).mapInArrow(run, "leaf long, bits long, n long")
              .groupBy("leaf", "bits").agg(F.sum("n").alias("n"))).toArrow()
    return Background.of(*[counts.column(i).to_numpy() for i in range(3)], len(leaves.value))


def _array(inputs: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in inputs]).alias("_x")


def tree_shapley(leaves: Leaves, background: Background, rows: DataFrame,
                 inputs: Sequence[str], *, key: str) -> DataFrame:
    """(row, feature): exact values; those of a row add up to its value less the mean one."""
    find_package(rows.sparkSession)
    key_type = rows.schema[key].dataType.simpleString()
    names = np.array(leaves.features, object)

    step = max(1, CELLS // max(1, len(leaves.bounds[0])))

    def run(items):
        for batch in items:
            whole = _matrix(batch.column(1), len(inputs))
            for start in range(0, len(whole), step):
                x = whole[start:start + step]
                found = values_of(leaves, background, x)
                keys = batch.column(0).take(
                    pa.array(np.repeat(np.arange(start, start + len(x)), len(names))))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.tile(names, len(x))), pa.array(found.ravel())],
                    names=[key, "feature", "value"])

    return rows.select(key, _array(inputs)).mapInArrow(
        run, f"`{key}` {key_type}, feature string, value double")


# ---- fitted models --------------------------------------------------------

def model_trees(model: Model, spark: SparkSession) -> list[Tree]:
    """Trees of a fitted ensemble whose weighted values add up to the log-odds of boosted trees,
    or to the probability of class 1 of a forest; read from the model's stored node table."""
    if hasattr(model, "as_trees"):
        return model.as_trees()
    with staged_folder(spark, "trees") as path:
        model.write().overwrite().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    boosted = not hasattr(model, "numClasses") or "GBT" in type(model).__name__
    weights = [2.0 * w for w in model.treeWeights] if boosted else [
        1.0 / len(model.treeWeights)] * len(model.treeWeights)
    trees = [Tree({}, w) for w in weights]
    for row in nodes:
        if row["leftChild"] >= 0:
            split = row["split"]
            node = (split["featureIndex"], split["leftCategoriesOrThreshold"][0],
                    row["leftChild"], row["rightChild"])
        elif boosted:
            node = row["prediction"]
        else:
            node = row["impurityStats"][1] / sum(row["impurityStats"])
        trees[row["treeID"]].nodes[row["id"]] = node
    return trees


def ensemble_leaves(models: Sequence[Model], inputs: Sequence[str],
                    spark: SparkSession) -> Leaves:
    """Leaves whose total is the mean over the folds' models."""
    trees = [Tree(t.nodes, t.weight / len(models))
             for model in models for t in model_trees(model, spark)]
    return leaves_of(trees, inputs)
