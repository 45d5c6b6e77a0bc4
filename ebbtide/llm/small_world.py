"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.llm.staging import id_back, id_or_least, keep, only

SHARD_ROWS = 8192
QUERY_ROWS = 1024
LINKS = 16  # of a node on the upper layers, twice as many on the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
AT_ONCE = 512
EXPANDED = 4


def doubles(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, each scaled by a power of two so that squares stay finite."""
    vectors = vectors.astype(np.float64)
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -power[:, None])


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of paired rows, added from the first component to the last on every machine."""
    return np.cumsum(left * right, axis=1)[:, -1]


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = doubles(vectors)
    length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled / length[:, None]


def beam(queries: np.ndarray, starts: np.ndarray, vectors: np.ndarray, links: np.ndarray,
         width: int) -> tuple[np.ndarray, np.ndarray]:
    """The best-first search of one layer, for many queries side by side.

    Returns places, -1 where there are fewer, and similarities, best first. Each step opens the
    EXPANDED nearest nodes of every query that are not open yet; a query ends when none of its
    width nearest is left to open.
    """
    rows, size = len(queries), len(vectors)
    seen = np.zeros((rows, size), bool)
    found = np.full((rows, width), -1, np.int32)
    near = np.full((rows, width), -np.inf)
    closed = np.ones((rows, width), bool)

    def push(row: np.ndarray, place: np.ndarray) -> None:
        fine = place >= 0
        row, place = row[fine], place[fine]
        fine = ~seen[row, place]
        row, place = np.divmod(np.unique(row[fine].astype(np.int64) * size + place[fine]), size)
        seen[row, place] = True
        alike = np.einsum("ij,ij->i", queries[row], vectors[place])
        fine = alike > near[row, -1]
        row, place, alike = row[fine], place[fine], alike[fine]
        if not len(row):
            return
        touched, first, counts = np.unique(row, return_index=True, return_counts=True)
        slot = np.arange(len(row)) - np.repeat(first, counts)
        line = np.repeat(np.arange(len(touched)), counts)
        shape = len(touched), counts.max()
        more, more_near = np.full(shape, -1, np.int32), np.full(shape, -np.inf)
        more[line, slot], more_near[line, slot] = place, alike
        all_near = np.concatenate([near[touched], more_near], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near[touched] = np.take_along_axis(all_near, order, axis=1)
        found[touched] = np.take_along_axis(
            np.concatenate([found[touched], more], axis=1), order, axis=1)
        closed[touched] = np.take_along_axis(
            np.concatenate([closed[touched], more < 0], axis=1), order, axis=1)

    push(np.repeat(np.arange(rows), starts.shape[1]), starts.ravel())
    active = np.arange(rows)
    while True:
        waiting = ~closed[active]
        still = waiting.any(axis=1)
        active, waiting = active[still], waiting[still]
        if not len(active):
            return found, near
        line, slot = np.nonzero(waiting & (np.cumsum(waiting, axis=1) <= EXPANDED))
        row = active[line]
        closed[row, slot] = True
        next_to = links[found[row, slot]]
        push(np.repeat(row, links.shape[1]), next_to.ravel())


def diverse(places: np.ndarray, near: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Per row up to most of the places, given best first: those not nearer to one already taken
    than to the row's own node, then the best of the rest."""
    among = vectors[places]
    alike = among @ among.transpose(0, 2, 1)
    taken = np.zeros(places.shape, bool)
    shut = places < 0
    for at in range(places.shape[1]):
        take = ~shut[:, at] & (taken.sum(axis=1) < most)
        taken[:, at] = take
        shut |= take[:, None] & (alike[:, at, :] > near)
    order = np.argsort(np.where(taken, 0, 1) + 2 * (places < 0), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(places, order, axis=1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def link_back(links: np.ndarray, vectors: np.ndarray, new: np.ndarray) -> None:
    """Adds the new nodes to the lists of those they chose; full lists are chosen anew."""
    most = links.shape[1]
    source = np.repeat(new, most)
    target = links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    missing = ~(links[target] == source[:, None]).any(axis=1)
    source, target = source[missing], target[missing]
    alike = np.einsum("ij,ij->i", vectors[source], vectors[target])
    order = np.lexsort((-alike, target))
    source, target = source[order], target[order]
    chosen, first, counts = np.unique(target, return_index=True, return_counts=True)
    slot = np.arange(len(target)) - np.repeat(first, counts)
    line = np.repeat(np.arange(len(chosen)), counts)
    inside = slot < 2 * most
    incoming = np.full((len(chosen), 2 * most), -1, np.int32)
    incoming[line[inside], slot[inside]] = source[inside]
    for begin in range(0, len(chosen), AT_ONCE):
        part = chosen[begin:begin + AT_ONCE]
        places = np.concatenate([links[part], incoming[begin:begin + AT_ONCE]], axis=1)
        near = np.einsum("ikj,ij->ik", vectors[places], vectors[part])
        near[places < 0] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")[:, :2 * most]
        places = np.take_along_axis(places, order, axis=1)
        near = np.take_along_axis(near, order, axis=1)
        full = (places >= 0).sum(axis=1) > most
        links[part] = places[:, :most]
        if full.any():
            links[part[full]] = diverse(places[full], near[full], vectors, most)


def layer_sizes(size: int) -> list[int]:
    """Nodes on each layer from the lowest up: nodes are in random order, a layer is a prefix."""
    out = [size]
    while out[-1] > LINKS:
        out.append(-(-out[-1] // LINKS))
    return out


@dataclass
class Graph:
    """Unit vectors and a flat neighbour array per layer, lowest first; -1 is no neighbour."""

    vectors: np.ndarray
    layers: list[np.ndarray]

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Builds the layers from the highest; each adds its own nodes to those it inherits."""
        graph = cls(vectors, [])
        sizes = layer_sizes(len(vectors))
        for depth in reversed(range(len(sizes))):
            most = LINKS if depth else 2 * LINKS
            graph.layers.insert(0, np.full((sizes[depth], most), -1, np.int32))
            done = 0
            while done < sizes[depth]:
                new = np.arange(done, min(sizes[depth], done + min(AT_ONCE, max(done, 256))))
                graph.insert(new, done)
                done += len(new)
        return graph

    def insert(self, new: np.ndarray, done: int) -> None:
        """Adds nodes to the layer under way, which has done nodes: they are compared with what
        a search among these finds, and with each other."""
        links, own = self.layers[0], self.vectors[new]
        alike = own @ own.T
        np.fill_diagonal(alike, -np.inf)
        count = min(BUILD_WIDTH, len(new) - 1)
        best = np.argsort(-alike, axis=1, kind="stable")[:, :count]
        places, near = new[best], np.take_along_axis(alike, best, axis=1)
        if done:
            old, old_near = beam(own, self.entries(own, 1, done), self.vectors[:done],
                                 links[:done], BUILD_WIDTH)
            places = np.concatenate([old, places], axis=1)
            near = np.concatenate([old_near, near], axis=1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :BUILD_WIDTH]
            places = np.take_along_axis(places, order, axis=1)
            near = np.take_along_axis(near, order, axis=1)
        if places.shape[1]:
            chosen = diverse(places.astype(np.int32), near, self.vectors, LINKS)
            links[new, :LINKS] = chosen
            link_back(links, self.vectors, new)

    def entries(self, queries: np.ndarray, down_to: int, below: int | None = None) -> np.ndarray:
        """The nearest few nodes that the layers from the highest to down_to lead to."""
        starts = np.zeros((len(queries), 1), np.int32)
        for links in reversed(self.layers[down_to:]):
            starts, _ = beam(queries, starts, self.vectors[:len(links)], links, EXPANDED)
        if below is not None:
            starts = np.where(starts < below, starts, -1)
            starts[:, 0] = np.where((starts < 0).all(axis=1), 0, starts[:, 0])
        return starts

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Places of the width nearest found for unit vectors, -1 where there are fewer."""
        found, _ = beam(queries, self.entries(queries, 1), self.vectors, self.layers[0], width)
        return found


def folded(rows: DataFrame, most: int) -> DataFrame:
    """(size, k1, k2, ids, vector): each distinct vector with the most smallest of its ids."""
    rank = Window.partitionBy("size", "k1", "k2").orderBy("id")
    return (rows.withColumn("rank", F.dense_rank().over(rank)).where(F.col("rank") <= most)
            .groupBy("size", "k1", "k2").agg(F.sort_array(F.collect_set("id")).alias("ids"),
                                             F.any_value("vector").alias("vector")))


def matrix(vectors: pa.ListArray, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def built(nodes: DataFrame) -> DataFrame:
    """One row per shard: ids and original vectors of its nodes, sizes and links of its layers."""
    kind = nodes.schema["vector"].dataType.simpleString()
    item = nodes.schema["vector"].dataType.elementType.simpleString()
    flat = pa.float32() if item == "float" else pa.float64()

    def run(key, shard):
        shard = shard.sort_by([("k2", "ascending"), ("k1", "ascending")])
        size = key[0].as_py()
        vectors = matrix(shard.column("vector").combine_chunks(), size)
        graph = Graph.build(units(vectors))
        return pa.table({
            "size": pa.array([size], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()),
            "ids": pa.array([shard.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": whole(vectors.ravel(), flat),
            "layers": pa.array([[len(links) for links in graph.layers]], pa.list_(pa.int32())),
            "links": whole(np.concatenate([links.ravel() for links in graph.layers]), pa.int32())})

    def whole(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays([0, len(values)], pa.array(values, kind))

    return nodes.groupBy("size", "shard").applyInArrow(
        run, f"size int, shard long, ids array<array<long>>, vectors {kind}, layers array<int>, "
             "links array<int>")


class Shard:
    """A shard's graph and what is needed to score its nodes, from a stored row."""

    def __init__(self, size: int, vectors: np.ndarray, layers: list[int], links: np.ndarray,
                 ids: pa.ListArray):
        vectors = vectors.reshape(-1, size)
        parts, at = [], 0
        for depth, rows in enumerate(layers):
            width = LINKS if depth else 2 * LINKS
            parts.append(links[at:at + rows * width].reshape(rows, width))
            at += rows * width
        self.graph = Graph(units(vectors), parts)
        self.exact = doubles(vectors)
        self.length = np.sqrt(dots(self.exact, self.exact))
        self.starts, self.ids = ids.offsets.to_numpy(), ids.values.to_numpy()

    def nearest(self, queries: np.ndarray, width: int, most: int):
        """(query, id, score) of the most nearest ids found for each query, best first."""
        exact = doubles(queries)
        length = np.sqrt(dots(exact, exact))
        for begin in range(0, len(queries), AT_ONCE):
            part = slice(begin, begin + AT_ONCE)
            found = self.graph.search(units(queries[part]), width)
            row, slot = np.nonzero(found >= 0)
            place = found[row, slot]
            score = (dots(exact[part][row], self.exact[place])
                     / (length[part][row] * self.length[place]))
            copies = self.starts[place + 1] - self.starts[place]
            first = np.cumsum(copies) - copies
            at = np.arange(copies.sum()) - np.repeat(first, copies)
            ids = self.ids[np.repeat(self.starts[place], copies) + at]
            row, score = np.repeat(row, copies), np.repeat(score, copies)
            order = np.lexsort((ids, -score, row))
            row, ids, score = row[order], ids[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            yield begin + row[rank < most], ids[rank < most], score[rank < most]


def searched(pairs: DataFrame, width: int, most: int) -> DataFrame:
    """(size, k1, k2, id, score) from rows of a block of queries beside a shard."""
    def run(items):
        known = None
        for batch in items:
            for at in range(batch.num_rows):
                one = {name: batch.column(name)[at] for name in batch.schema.names}
                size = one["size"].as_py()
                queries = one["queries"].values
                if known != (size, one["shard"].as_py()):  # a shard's blocks mostly come in a row
                    known = size, one["shard"].as_py()
                    shard = Shard(size, one["vectors"].values.to_numpy(), one["layers"].as_py(),
                                  one["links"].values.to_numpy(), one["ids"].values)
                k1, k2 = (queries.field(name).to_numpy() for name in ("k1", "k2"))
                vectors = matrix(queries.field("vector"), size)
                for row, ids, score in shard.nearest(vectors, width, most):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), size, np.int32)), pa.array(k1[row]),
                         pa.array(k2[row]), pa.array(ids), pa.array(score)],
                        names=["size", "k1", "k2", "id", "score"])

    return pairs.mapInArrow(run, "size int, k1 long, k2 long, id long, score double")


def paired(blocks: DataFrame, index: DataFrame, count: int, shards: int) -> DataFrame:
    """Each of the count blocks of queries beside each shard's row.

    Blocks are sent to the shards: a shard is sent once, or to a few tasks that share its blocks
    where shards are fewer than partitions. Neither side may be broadcast, since Spark takes the
    blocks to be as large as before they are repeated for every shard.
    """
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = min(count, -(-2 * parts // shards))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    sent = (blocks.withColumn("group", F.pmod("block", F.lit(groups).cast("long")))
            .withColumn("shard", every(shards)))
    return sent.hint("merge").join(index.withColumn("group", every(groups)),
                                   ["size", "shard", "group"])


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, size, k1, k2) of the rows whose vector can be compared."""
    listed = only(rows, id=key, vector=vector)
    fine = ((F.size("vector") > 0)
            & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0))
    return listed.where(F.coalesce(fine, F.lit(False))).select(
        id_or_least("id").alias("id"), "vector", F.size("vector").alias("size"),
        F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"))


def build_index(rows: DataFrame, *, most: int, shard_rows: int = SHARD_ROWS,
                key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """The stored graphs of all rows, and the number of shards they are dealt to.

    Equal vectors are one node with the most smallest of their ids, which is all that a search
    for that many can return. Vectors go to shards by their hash, about shard_rows to each.
    """
    nodes = keep(folded(usable(rows, key, vector), most))
    shards = max(1, -(-nodes.count() // shard_rows))
    return keep(built(nodes.withColumn("shard", F.pmod("k1", F.lit(shards))))), shards


def nearest_neighbours(queries: DataFrame, rows: DataFrame, *, k: int = 5,
                       width: int = SEARCH_WIDTH, shard_rows: int = SHARD_ROWS,
                       query_rows: int = QUERY_ROWS, key: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for each query.

    Queries are rows too: rows that carry a query's id are not its candidates. Every shard's graph
    is searched for every query, in blocks of about query_rows distinct vectors, with width nodes
    at hand; what is found is scored in double precision on the original vectors, ties go to the
    smaller id, NULL first. Vectors that are NULL, empty, zero or hold NULL or non-finite
    components take no part, vectors of another size are no candidates. A query without
    candidates has no rows; queries that share id and vector are one, so are such rows.
    """
    index, shards = build_index(rows, most=k + 1, shard_rows=shard_rows, key=key, vector=vector)
    asked = keep(usable(queries, key, vector).dropDuplicates(["id", "k1", "k2", "size"]))
    wanted = asked.groupBy("size", "k1", "k2").agg(F.any_value("vector").alias("vector"))
    blocks = max(1, -(-asked.count() // query_rows))
    listed = wanted.groupBy("size", F.pmod("k2", F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("k1", "k2", "vector")).alias("queries"))
    found = keep(searched(paired(listed, index, blocks, shards), width, k + 1), 1)
    best = Window.partitionBy("size", "k1", "k2").orderBy(F.desc("score"), "id")
    hits = (found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
            .groupBy("size", "k1", "k2")
            .agg(F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("hits")))
    others = F.slice(F.filter("hits", lambda hit: hit["id"] != F.col("id")), 1, k)
    listed = asked.select("id", "size", "k1", "k2").join(hits, ["size", "k1", "k2"]).select(
        F.col("id").alias("query"), F.posexplode(others).alias("at", "hit"))
    return listed.select(
        id_back(F.col("query")).alias("query_id"), (F.col("at") + 1).alias("rank"),
        id_back(F.col("hit.id")).alias("vec_id"), F.col("hit.score").alias("score"))


def nearest_sql(k: int = 5, every: int = 50) -> str:
    """The k nearest of every so manieth row of the table embeddings, by comparing all rows."""
    return f"""
WITH rows AS (
  SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x),
                                     lambda total, x: total + x)) AS length
  FROM (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]),
                     lambda total, x: total + x) / (q.length * c.length) AS score
  FROM rows q JOIN rows c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % {every} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER
         AS rank, vec_id, score
FROM pairs QUALIFY rank <= {k}"""
