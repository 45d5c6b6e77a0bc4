"""SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.components import components, local_labels, star_groups
from ebbtide.llm.staging import (
    batches, drop, id_back, id_or_least, keep, only, unused)

PARTS = 4
BASE = 32
TILE = 1024
LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of word shingles; bit b is set if over half of the hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    count = len(words) - size + 1
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64, count)
    ones = np.zeros(64, np.int64)
    cuts = np.arange(0, count, 255)
    for bit in range(8):  # eight byte-wide counters in one word, at most 255 hashes at a time
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, cuts)
        ones[bit::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > count).tolist()))


def fingerprints(docs: DataFrame, shingle: int = 3, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc, fp): doc is the id with NULL as the least long, fp the fingerprint as a long."""
    def run(items):
        for batch in batches(items, 4 << 20):
            seen: dict[bytes, int] = {}
            out = []
            for value in batch.column(1).cast(pa.binary()).to_pylist():
                value = value or b""
                if value not in seen:
                    seen[value] = fingerprint(value, shingle)
                out.append(seen[value])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64))],
                names=["doc", "fp"])

    rows = only(docs, doc=key, text=text).select(
        id_or_least("doc").alias("doc"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc long, fp long")


def cell(fp: Column) -> Column:
    """Population counts of the four 16-bit parts, packed into one number."""
    parts = [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("long")
             * (BASE ** i) for i in range(PARTS)]
    return sum(parts[1:], parts[0])


def neighbours(radius: int) -> list[int]:
    """Non-negative steps between cells whose population counts differ by at most radius."""
    steps = (s for s in product(range(-radius, radius + 1), repeat=PARTS)
             if sum(map(abs, s)) <= radius)
    return sorted(c for s in steps if (c := sum(x * BASE ** i for i, x in enumerate(s))) >= 0)


def compare(left: np.ndarray, right: np.ndarray, radius: int):
    """Index pairs of two tiles whose fingerprints differ in at most radius bits."""
    apart = np.bitwise_count(left[:, None] ^ right[None, :])
    return np.nonzero(apart <= radius)


def linked_groups(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """prints(fp), distinct -> (grp, node): groups that connect all fingerprints in reach.

    Tiles hold the fingerprints of one cell, a crowded cell is cut into several. Two fingerprints
    within the radius lie in cells whose counts differ by no more, so only such tile pairs meet,
    each pair once, as one row with two arrays. A row gives back a spanning forest, not pairs.
    """
    celled = prints.select("fp", cell(F.col("fp")).alias("cell"))
    # at most 17 ** 4 cells exist, so this table is bounded whatever the corpus
    crowded = (celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > tile).select("cell", F.ceil(F.col("n") / tile).alias("cuts")))
    cut = F.pmod(F.xxhash64("fp"), F.coalesce("cuts", F.lit(1)))
    tiles = keep(celled.join(F.broadcast(crowded), "cell", "left")
                 .groupBy("cell", cut.alias("cut"))
                 .agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    steps = F.array(*[F.lit(s).cast("long") for s in neighbours(radius)])
    left = tiles.select(F.col("cell").alias("home"), F.col("cut").alias("home_cut"),
                        F.col("fps").alias("left"), F.explode(steps).alias("step"))
    pairs = left.withColumn("cell", F.col("home") + F.col("step")).join(tiles, "cell").where(
        (F.col("step") > 0) | (F.col("home_cut") <= F.col("cut")))

    def run(items):
        for batch in items:
            names, nodes = [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for where, same, a, b in zip(*columns):
                a = np.array(a, np.int64).view(np.uint64)
                b = a if same else np.array(b, np.int64).view(np.uint64)
                i, j = compare(a, b, radius)
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                both = a if same else np.concatenate([a, b])
                labels = local_labels(len(both), i, j if same else j + len(a))
                for number, group in enumerate(star_groups(labels)):
                    names += [f"{where}:{number}"] * len(group)
                    nodes.append(both[group].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64))],
                names=["grp", "node"])

    same = (F.col("step") == 0) & (F.col("home_cut") == F.col("cut"))
    pairs = pairs.select(
        F.concat_ws("-", "home", "home_cut", "cell", "cut").alias("pair"), same.alias("same"),
        "left", F.when(~same, F.col("fps")).alias("right"))
    return pairs.repartition("pair").mapInArrow(run, "grp string, node long")


def simhash_groups(docs: DataFrame, *, shingle: int = 3, radius: int = 2, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Per row of docs: key, fingerprint (16 hex digits) and component_id.

    Fingerprints that differ in at most radius bits are linked; component_id is the smallest id
    reachable. A text without words, or NULL, has fingerprint zero and is linked like any
    other; fewer words than a shingle count as one shingle. Rows are kept as often as they
    come, a NULL id sorts before all others, other columns are ignored, an empty table gives
    an empty result.
    """
    rows = keep(fingerprints(docs, shingle, key=key, text=text))
    prints = keep(rows.groupBy("fp").agg(F.min("doc").alias("first")))
    linked = keep(linked_groups(prints.select("fp"), radius), batch_rows=256)
    roots = components(linked)
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = keep(rooted.groupBy("root").agg(F.min("first").alias("component")))
    where = keep(rooted.join(least, "root").select("fp", "component"))
    for table in (prints, linked, roots, least):
        drop(table)
    return rows.join(where, "fp").select(
        id_back(F.col("doc")).alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        id_back(F.col("component")).alias("component_id"))


def keep_first(docs: DataFrame, *, shingle: int = 3, radius: int = 2, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The rows of docs, all columns, that hold the smallest id of their group.

    Ids are taken to be unique; rows that share the smallest id all stay.
    """
    groups = simhash_groups(docs, shingle=shingle, radius=radius, key=key, text=text)
    [other] = unused(docs, "gone_id")
    gone = groups.where(~F.col(key).eqNullSafe(F.col("component_id"))).select(
        F.col(key).alias(other)).distinct()
    return docs.join(gone, docs[key].cast("long").eqNullSafe(gone[other]), "left_anti")
