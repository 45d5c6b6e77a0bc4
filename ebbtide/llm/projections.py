"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbtide.llm.components import components, local_labels, star_groups
from ebbtide.llm.staging import drop, id_back, id_or_least, keep, only

PASSES = 12  # at least
RECALL = 0.95  # aimed at for pairs at the threshold among the most crowded third of the vectors
PROBES = 600
TRIALS = 32
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 16 << 20
BLOCK = 512
HASHES = 3
TILES_AT_ONCE = 16
NEAR = 8
SLACK = 1e-4  # single precision finds candidates this far below the threshold


def rotations(size: int, number: int) -> np.ndarray:
    """HASHES random matrices of one pass for vectors of one size; the same on every machine."""
    draw = np.random.default_rng([size, number])
    return draw.standard_normal((HASHES, size, size))


def pass_keys(vectors: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated hashes and a last projection of unit vectors.

    A hash is the axis, with its sign, that a random rotation brings the vector closest to:
    vectors with a small angle between them often share it, and it tells many places apart.
    """
    size = vectors.shape[1]
    key = np.zeros(len(vectors), np.int64)
    for turn in rotations(size, number):
        turned = vectors @ turn
        axis = np.abs(turned).argmax(axis=1)
        sign = np.take_along_axis(turned, axis[:, None], axis=1)[:, 0] < 0
        key = key * (2 * size) + 2 * axis + sign
    return key, turned[:, 0]


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # keeps squares from overflowing
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def partners(units: np.ndarray, among: np.ndarray, least: float, draw) -> np.ndarray:
    """For each vector one at the cosine least, turned towards a random vector of among."""
    towards = among[draw.integers(0, len(among), len(units))]
    towards = towards + 1e-3 * draw.standard_normal(units.shape)
    aside = towards - np.einsum("ij,ij->i", towards, units)[:, None] * units
    aside /= np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    return least * units + math.sqrt(1 - least * least) * aside


def passes_for(units: np.ndarray, rows: int, least: float, block: int) -> int:
    """Passes that vectors like the unit vectors of a sample need if there are rows of them.

    Pairs at the threshold are added to the sample and sorted as a pass does; a pair that is w
    places apart is w times rows over the sample's size apart in the table, and met if that is
    at most a block. Where a block is less than NEAR places of the sample, the chance is carried
    on as a power of the distance. The third of the pairs that lies furthest apart decides; half
    of the trials tells which pairs these are, the other half how often they are met.
    """
    if rows <= 2 * block or least >= 1 or len(units) < NEAR or units.shape[1] < 2:
        return PASSES
    draw = np.random.default_rng([units.shape[1], len(units)])
    at = draw.integers(0, len(units), PROBES)
    everything = np.concatenate([units, partners(units[at], units, least, draw)])
    apart = np.empty((TRIALS, PROBES))
    for number in range(TRIALS):
        key, along = pass_keys(everything, number)
        place = np.empty(len(everything), np.int64)
        place[np.lexsort((along, key))] = np.arange(len(everything))
        apart[number] = np.abs(place[at] - place[len(units):])
    within = block * len(everything) / rows
    far = np.argsort(np.median(apart[::2], axis=0))[-(PROBES // 3):]
    apart = apart[1::2, far]

    def met(width: float) -> float:
        return max(float((apart <= width).mean()), 1 / apart.size)

    chance = met(max(within, NEAR))
    if within < NEAR:
        power = math.log(met(8 * NEAR) / chance) / math.log(8)
        chance *= (within / NEAR) ** max(power, 0.0)
    # the partners lie at the edge of a crowd, where it is thinner: half the chance is counted on
    return max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-min(chance / 2, 0.999))))


def needed_passes(vectors: DataFrame, least: float, block: int) -> int:
    """Passes for a table of unequal vectors, from a sample of bounded size."""
    rows, longest = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if rows <= 2 * block:
        return PASSES
    wanted = min(SAMPLE_ROWS, max(NEAR, SAMPLE_BYTES // (8 * longest)))
    share = min(1.0, wanted / rows)
    sample = (vectors if share == 1 else vectors.sample(share, 1)).select("vector").toArrow()
    sizes = np.array([len(v) for v in sample.column(0)], np.int64)
    most = PASSES
    for size in np.unique(sizes).tolist():
        picked = sample.column(0).take(pa.array(np.flatnonzero(sizes == size)))
        units = unit(picked.combine_chunks().flatten().to_numpy().reshape(-1, size))
        most = max(most, passes_for(units, round(len(units) / share), least, block))
    return most


def keyed_passes(vectors: DataFrame, passes: int) -> DataFrame:
    """(turn, size, key, along, node, n, vector): each vector once per pass."""
    kind = vectors.schema["vector"].dataType.simpleString()

    def run(items):
        for batch in items:
            nodes, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                picked = batch.column(2).take(pa.array(rows))
                units = unit(picked.flatten().to_numpy().reshape(-1, size))
                for number in range(passes):
                    key, along = pass_keys(units, number)
                    same = np.full(len(rows), 1, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(same * number), pa.array(same * size), pa.array(key),
                         pa.array(along), pa.array(nodes[rows]), pa.array(counts[rows]), picked],
                        names=["turn", "size", "key", "along", "node", "n", "vector"])

    return vectors.mapInArrow(
        run, "turn int, size int, key long, along double, node long, n long, "
             f"vector {kind}")


def tiles(keyed: DataFrame, block: int) -> DataFrame:
    """(tile, rows): the vectors of all passes in order, cut into blocks of equal length."""
    order = ["turn", "size", "key", "along", "node"]
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = keep(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                       .withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_part"))
    # one number for each partition of the shuffle, as many as the driver has tasks anyway
    before, total = {}, 0
    for row in sorted(sizes.collect()):
        before[row["part"]] = total
        total += row["n_part"]
    starts = sorted_rows.sparkSession.createDataFrame(
        list(before.items()) or [(0, 0)], "part long, before long")
    ranked = sorted_rows.withColumn("part", part).join(F.broadcast(starts), "part")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return keep(ranked.groupBy(F.floor(rank / block).alias("tile")).agg(F.collect_list(
        F.struct("turn", "size", "node", "n", "vector")).alias("rows")))


class Tile:
    """The rows of one tile as arrays, without copying the vectors."""

    def __init__(self, rows: pa.StructArray):
        self.node = rows.field("node").to_numpy()
        self.n = rows.field("n").to_numpy()
        turn, size = rows.field("turn").to_numpy(), rows.field("size").to_numpy()
        vectors = rows.field("vector")
        starts = vectors.offsets.to_numpy()
        values = vectors.values.to_numpy()
        self.parts = {}
        for kind in np.unique(np.stack([turn, size], axis=1), axis=0).tolist():
            at = np.flatnonzero((turn == kind[0]) & (size == kind[1]))
            self.parts[tuple(kind)] = at, unit(
                values[starts[at][:, None] + np.arange(kind[1])])


def compare(left: Tile, right: Tile, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two tiles, or inside one, with a cosine of at least least, in double precision."""
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for kind in left.parts.keys() & right.parts.keys():
        (a, ua), (b, ub) = left.parts[kind], right.parts[kind]
        near = ua.astype(np.float32) @ ub.astype(np.float32).T >= least - SLACK
        i, j = np.nonzero(np.triu(near, 1) if left is right else near)
        sure = np.einsum("ij,ij->i", ua[i], ub[j]) >= least
        out_i.append(a[i[sure]])
        out_j.append(b[j[sure]])
    return np.concatenate(out_i), np.concatenate(out_j)


def compared(pairs: DataFrame, least: float) -> DataFrame:
    """pairs(tile, left, right) -> links (a, b, n_a, n_b), and groups (grp, a) that connect them.

    right is NULL for a tile with itself. Every tile with a link also gives (tile).
    """
    def run(items):
        for batch in items:
            for row in range(batch.num_rows):
                where, apart = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                left = Tile(batch.column(2)[row].values)
                right = Tile(batch.column(3)[row].values) if apart else left
                i, j = compare(left, right, least)
                if not len(i):
                    continue
                total = len(left.node) + (len(right.node) if apart else 0)
                shift = len(left.node) if apart else 0
                node = np.concatenate([left.node, right.node]) if apart else left.node
                n = np.concatenate([left.n, right.n]) if apart else left.n
                j = j + shift
                one, two = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                swap = node[i] > node[j]
                n_one, n_two = np.where(swap, n[j], n[i]), np.where(swap, n[i], n[j])
                other = one != two
                names, members = [], []
                for number, group in enumerate(star_groups(local_labels(total, i, j))):
                    names += [f"{where}+{apart}:{number}"] * len(group)
                    members.append(node[group])
                members = np.concatenate(members)
                blank = len(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([where] * (other.sum() + blank), pa.int64()),
                     pa.array([None] * other.sum() + names, pa.string()),
                     pa.array(np.concatenate([one[other], members])),
                     pa.array(two[other].tolist() + [None] * blank, pa.int64()),
                     pa.array(n_one[other].tolist() + [None] * blank, pa.int64()),
                     pa.array(n_two[other].tolist() + [None] * blank, pa.int64())],
                    names=["tile", "grp", "a", "b", "n_a", "n_b"])

    return pairs.mapInArrow(run, "tile long, grp string, a long, b long, n_a long, n_b long")


def neighbour_links(vectors: DataFrame, least: float, passes: int, block: int) -> DataFrame:
    """Every tile with itself and the next; where that gives links, also with those after it."""
    made = tiles(keyed_passes(vectors, passes), block)
    own = made.select("tile", F.lit(0).alias("apart"), F.col("rows").alias("left"),
                      F.lit(None).cast(made.schema["rows"].dataType).alias("right"))
    found = keep(compared(own.repartition("tile"), least), TILES_AT_ONCE)
    apart, active = 1, made.select("tile")
    while True:
        later = made.select((F.col("tile") - apart).alias("tile"), F.col("rows").alias("right"))
        pairs = (made.join(active, "tile").withColumnRenamed("rows", "left").join(later, "tile")
                 .select("tile", F.lit(apart).alias("apart"), "left", "right"))
        more = keep(compared(pairs.repartition("tile"), least), TILES_AT_ONCE)
        if not more.limit(1).count():
            break
        found = found.unionByName(more)
        active = more.select("tile").distinct()
        apart += 1
    return found


def embedding_links(rows: DataFrame, *, least: float = 0.9, passes: int | None = None,
                    block: int = BLOCK, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """Per row: key, n_links, component_id and kept.

    vector is an array of floats or doubles. Equal vectors are folded into one first and counted as links of each other. In each pass the
    vectors are sorted by concatenated random hashes and compared inside blocks of block vectors
    and with the block after; as long as blocks have links, those further off are compared too,
    so a group larger than a block is found whole and nothing is capped. Pairs are verified in
    double precision, so no link is below least; some pairs close to it may be missed. Without
    passes their number follows from the number of vectors and how crowded they are. NULL or
    empty vectors, zero vectors and vectors with a NULL, infinite or NaN component link with
    nothing, vectors of unequal size neither. A NULL id sorts first; rows that share an id are
    one node of the graph. Other columns are ignored, an empty table gives an empty result.
    """
    listed = only(rows, id=key, vector=vector).select(
        id_or_least("id").alias("id"), F.col("vector"))
    fine = F.coalesce(
        (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0), F.lit(False))
    listed = keep(listed.select(
        "id", F.when(fine, F.col("vector")).alias("vector"))
        .withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")}))
    folded = keep(listed.where(F.col("vector").isNotNull()).groupBy("k1", "k2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("n"),
        F.any_value("vector").alias("vector")))
    if passes is None:
        passes = needed_passes(folded, least, block)
    found = neighbour_links(folded.select("node", "n", "vector"), least, passes, block)
    links = found.where(F.col("b").isNotNull()).select("a", "b", "n_a", "n_b").distinct()
    degree = (links.select(F.col("a").alias("node"), F.col("n_b").alias("n"))
              .unionAll(links.select(F.col("b").alias("node"), F.col("n_a").alias("n")))
              .groupBy("node").agg(F.sum("n").alias("linked")))
    groups = keep(found.where(F.col("grp").isNotNull()).select(
        "grp", F.col("a").alias("node")))
    roots = components(groups)
    known = keep(folded.select("k1", "k2", "node", "n").join(degree, "node", "left")
                 .join(roots, "node", "left").select(
        "k1", "k2", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("component")))
    for table in (groups, roots):
        drop(table)
    valid = F.col("vector").isNotNull()
    return (listed.select("id", "k1", "k2", valid.alias("valid"))
            .join(known.withColumn("valid", F.lit(True)), ["k1", "k2", "valid"], "left")
            .select(id_back(F.col("id")).alias(key),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    id_back(F.coalesce("component", "id")).alias("component_id"),
                    (F.coalesce("component", "id") == F.col("id")).alias("kept")))
