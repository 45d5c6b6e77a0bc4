"""Connected components of a graph given as small overlapping groups of nodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.staging import drop, keep

GROUP = 64


def local_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of n nodes along the given pairs."""
    labels = np.arange(n)
    while len(left):
        low = np.minimum(labels[left], labels[right])
        new = labels.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, labels):
            break
        labels = new
    return labels


def star_groups(labels: np.ndarray, size: int = GROUP) -> list[np.ndarray]:
    """Node sets that connect what labels says is connected, each of at most size nodes.

    Every set of a component holds its first node, so no set grows with the component.
    """
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    order = moved[np.argsort(labels[moved], kind="stable")]
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    out = []
    for members in np.split(order, cuts) if len(order) else []:
        for start in range(0, len(members), size - 1):
            part = members[start:start + size - 1]
            out.append(np.concatenate([labels[part[:1]], part]))
    return out


def components(members: DataFrame) -> DataFrame:
    """members(grp, node), a stored table -> (node, root): the smallest node reachable.

    Each round takes the least label over a node's groups, then that label's own label. Groups
    and the number of groups of a node are bounded by the caller, so no key is hot; the label
    look-up joins two stored tables, which adaptive execution can split. Rounds go on until no
    label changes. An empty input gives an empty table.
    """
    labels = keep(members.select("node", F.col("node").alias("root")).distinct())
    while True:
        least = members.join(labels, "node").groupBy("grp").agg(F.min("root").alias("root"))
        offered = (members.join(least, "grp").groupBy("node").agg(F.min("root").alias("root")))
        offered = keep(offered)
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = keep(offered.join(up, "root", "left").select(
            "node", F.least("root", "up").alias("root")))
        changed = (new.join(labels.withColumnRenamed("root", "was"), "node")
                   .where("root <> was").limit(1).count())
        drop(offered)
        drop(labels)
        labels = new
        if not changed:
            return labels
