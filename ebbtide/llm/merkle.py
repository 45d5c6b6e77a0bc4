"""Merkle manifest of a table: a tree over the rows of each group, and one over the groups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbtide.functions.skew import null_safe_join
from ebbtide.llm.staging import drop, keep, only

FANOUT = 16
STEP = "left string, right string"


def field(column: Column) -> Column:
    """A dash for NULL, else byte count, colon and value: no two lists of values look alike."""
    text = column.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def part_of(digests: Column, first: Column, count: Column) -> Column:
    """The concatenated digests at first .. first + count - 1, counted from 0."""
    return joined(F.slice(digests, first + F.lit(1), count))


def placed(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """Adds place, counted from 0 inside the group in that order, and n, the group's size.

    Rows are sorted over all partitions at once, so a large group spreads over many of them; a
    partition numbers its share of a group, shifted by the shares before it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(group).asc_nulls_first(), *order]
    listed = keep(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                  .withColumn("_at", F.monotonically_increasing_id()))
    listed = listed.withColumn("_part", F.shiftright("_at", 33))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = (listed.groupBy(group, "_part")
              .agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
              .select(group, "_part",
                      (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first"))
                      .alias("_shift"),
                      F.sum("_size").over(whole).alias("n")))
    return (null_safe_join(listed, shares, [group, "_part"])
            .withColumn("place", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_shift"))


def blocks(nodes: DataFrame, group: str, fanout: int) -> DataFrame:
    """(group, block, n, items): the aligned subtrees of two levels, each a row of its leaves."""
    items = [c for c in nodes.columns if c not in (group, "place", "n")]
    return (nodes.groupBy(group, F.floor(F.col("place") / (fanout * fanout)).alias("block"))
            .agg(F.any_value("n").alias("n"),
                 F.sort_array(F.collect_list(F.struct("place", *items))).alias("items"))
            .withColumn("items", F.transform("items", lambda i: F.struct(
                *[i[c].alias(c) for c in items]))))


def inner_nodes(fanout: int) -> Column:
    """The middle level of a block, made from what is stored; nothing keeps it."""
    runs = F.ceil(F.size("items") / fanout).cast("int")
    return F.transform(
        F.sequence(F.lit(0), runs - 1),
        lambda run: F.sha2(part_of(F.col("items.digest"), run * fanout, F.lit(fanout)), 256))


def lifted(stored: DataFrame, group: str, fanout: int) -> DataFrame:
    """The node above each block; a group with one node keeps it."""
    inner = inner_nodes(fanout)
    return stored.select(
        group, F.col("block").alias("place"),
        F.ceil(F.col("n") / (fanout * fanout)).alias("n"),
        F.when(F.col("n") == 1, F.col("items")[0]["digest"])
        .when(F.col("n") <= fanout, inner[0])
        .otherwise(F.sha2(joined(inner), 256)).alias("digest"))


def forest(nodes: DataFrame, group: str, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels, every second one of the trees from the leaves up, and (group, digest) of
    the roots."""
    levels = [keep(blocks(nodes, group, fanout))]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while True:
        roots = lifted(levels[-1], group, fanout)
        most = -(-most // (fanout * fanout))
        if most <= 1:
            return levels, roots.select(group, "digest")
        levels.append(keep(blocks(roots, group, fanout)))


def steps_of(place: Column, fanout: int) -> Column:
    """The one or two steps up from a place of a block: digests left and right in each run."""
    digests, own, run = F.col("items.digest"), place % fanout, F.floor(place / fanout).cast("int")
    low = F.struct(part_of(digests, place - own, own).alias("left"),
                   part_of(digests, place + 1, F.lit(fanout - 1) - own).alias("right"))
    high = F.struct(part_of(F.col("inner"), F.lit(0), run).alias("left"),
                    part_of(F.col("inner"), run + 1, F.lit(fanout)).alias("right"))
    return (F.when(F.col("n") == 1, F.array().cast(f"array<struct<{STEP}>>"))
            .when(F.col("n") <= fanout, F.array(low)).otherwise(F.array(low, high)))


def descend(levels: Sequence[DataFrame], above: DataFrame, group: str,
            fanout: int) -> DataFrame:
    """Leaves of all trees with their path: above(group, path, ...) holds that of each root.

    Goes down the stored levels; the nodes of a block share the path of the node above it.
    """
    shared = [c for c in above.columns if c not in (group, "path")]
    paths = above.withColumn("place", F.lit(0).cast("long"))
    for level in reversed(levels):
        items = level.schema["items"].dataType.elementType.names
        paths = paths.withColumnRenamed("place", "block")
        made = null_safe_join(
            level.withColumn("inner", inner_nodes(fanout)), paths, [group, "block"])
        made = made.withColumn("made", F.transform("items", lambda item, at: F.struct(
            *[item[c].alias(c) for c in items], at.alias("at"),
            steps_of(at, fanout).alias("steps"))))
        # the outer form, as for the plain one Spark adds a filter that makes the column twice
        made = made.select(group, "block", "path", *shared, F.inline_outer("made"))
        paths = made.select(
            group, (F.col("block") * fanout * fanout + F.col("at")).alias("place"), *items,
            F.concat("steps", "path").alias("path"), *shared)
        shared = [c for c in paths.columns if c not in (group, "place", "path", *items)]
        if level is not levels[0]:
            paths = paths.drop(*items)
    return paths


@dataclass
class Manifest:
    """Stored levels of the trees over rows and over groups, and the digest of everything."""

    levels: list[DataFrame]
    tops: list[DataFrame]
    subroots: DataFrame
    root: DataFrame
    fanout: int

    def proofs(self) -> DataFrame:
        """(key, carried columns, leaf, group, subroot, root, path) for each row of the table.

        path is an array of (left, right): the sibling digests, concatenated, on both sides at
        each level from the leaf to the root. Nodes between stored levels are computed again
        from the block below them, used and forgotten.
        """
        whole = self.root.select(
            "_all", F.array().cast(f"array<struct<{STEP}>>").alias("path"),
            F.col("digest").alias("root"))
        groups = (descend(self.tops, whole, "_all", self.fanout)
                  .select("group", F.col("digest").alias("subroot"), "path", "root"))
        return (descend(self.levels, groups, "group", self.fanout)
                .withColumnRenamed("digest", "leaf").drop("place"))


def build(rows: DataFrame, leaf: Column, *, key: str, group: str, fanout: int = FANOUT,
          carry: dict[str, Column] | None = None) -> Manifest:
    """Manifest of rows: leaf is each row's digest, key orders the leaves of a group.

    NULL keys and groups come first, rows that share a key are ordered by their digest, equal
    rows are each a leaf. carry names further columns that proofs() hands on. Only every second
    level is stored, each as rows of fanout squared nodes, below spark.checkpoint.dir.
    """
    carried = {name: column.alias(name) for name, column in (carry or {}).items()}
    leaves = keep(rows.select(F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"),
                              leaf.alias("digest"), *carried.values()))
    nodes = placed(leaves, "group", [F.col("key").asc_nulls_first(), F.col("digest")])
    levels, roots = forest(nodes, "group", fanout)
    subroots = keep(roots)
    for table in (leaves, nodes):
        drop(table)
    named = subroots.select(F.lit(0).alias("_all"), "group", "digest")
    tops, root = forest(placed(named, "_all", [F.col("group").asc_nulls_first()]), "_all", fanout)
    return Manifest(levels, tops, subroots, keep(root), fanout)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings_digest(path: Column) -> Column:
    return F.sha2(joined(F.transform(path, lambda step: F.concat(step["left"], step["right"]))),
                  256)


def manifest_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    The leaf covers doc_id, source, lang, n_chars and text, the trees are per source. Where 5
    divides the unsigned CRC-32 of the id's digits, the text's A-Z are lower-cased before the leaf
    is folded up again, so verified is false unless the text has none. A NULL id is not tampered
    with. Other columns are ignored; an empty table gives an empty result.
    """
    names = ("doc_id", "source", "lang", "n_chars", "text")
    rows = only(docs, **{name: name for name in names})
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                         F.lit(False))
    lower = F.translate("text", upper, upper.lower())
    original = digest(*[field(F.col(name)) for name in names])
    tampered = digest(*[field(F.col(name)) for name in names[:-1]], field(lower))
    manifest = build(rows, original, key="doc_id", group="source",
                     carry={"tampered": F.when(changed, tampered)})
    out = manifest.proofs().select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(fanout: int = FANOUT) -> str:
    """manifest_digests over the table documents, with recursive unions in place of levels."""
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' ||
           CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz')
                ELSE text END, '-')) AS changed
  FROM (SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                         coalesce(strlen(source) || ':' || source, '-'),
                         coalesce(strlen(lang) || ':' || lang, '-'),
                         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
               coalesce(xor(4294967295::UBIGINT, list_reduce(
                 list_prepend(4294967295::UBIGINT, list_transform(
                   range(1, strlen(doc_id::VARCHAR) + 1),
                   lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT)),
                 lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), [0::UBIGINT for _ in range(8)]),
                   lambda c, zero: xor(c >> 1, 3988292384::UBIGINT * (c & 1)) + zero))),
               1) AS crc
        FROM documents) AS d),
tree AS (
  SELECT source, 0 AS level, leaf AS digest, row_number() OVER w - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
  UNION ALL
  SELECT source, level + 1, sha256(string_agg(digest, '' ORDER BY place)), place // {fanout},
         any_value((n + {fanout - 1}) // {fanout})
  FROM tree WHERE n > 1 GROUP BY source, level, place // {fanout}),
subroots AS (SELECT source, digest AS subroot FROM tree WHERE n = 1),
top AS (
  SELECT source, 0 AS level, subroot AS digest,
         row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM subroots
  UNION ALL
  SELECT NULL, level + 1, sha256(string_agg(digest, '' ORDER BY place)), place // {fanout},
         any_value((n + {fanout - 1}) // {fanout})
  FROM top WHERE n > 1 GROUP BY level, place // {fanout}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves),
sides AS (
  SELECT t.source, t.level, t.place, t.n,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < t.place), '') AS before,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > t.place), '') AS after
  FROM tree t JOIN tree o ON o.source IS NOT DISTINCT FROM t.source AND o.level = t.level
       AND o.place // {fanout} = t.place // {fanout}
  WHERE t.n > 1 GROUP BY ALL),
top_sides AS (
  SELECT t.level, t.place,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < t.place), '') AS before,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > t.place), '') AS after
  FROM top t JOIN top o ON o.level = t.level AND o.place // {fanout} = t.place // {fanout}
  WHERE t.n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, source, leaf, place, 0 AS level, false AS above, '' AS proof, changed AS node
  FROM numbered
  UNION ALL
  SELECT c.doc_id, c.source, c.leaf,
         CASE WHEN c.above THEN c.place // {fanout} WHEN s.level IS NULL THEN g.place ELSE c.place // {fanout} END,
         CASE WHEN c.above OR s.level IS NOT NULL THEN c.level + 1 ELSE 0 END,
         c.above OR s.level IS NULL,
         CASE WHEN c.above THEN c.proof || u.before || u.after
              WHEN s.level IS NULL THEN c.proof ELSE c.proof || s.before || s.after END,
         CASE WHEN c.above THEN sha256(u.before || c.node || u.after)
              WHEN s.level IS NULL THEN c.node ELSE sha256(s.before || c.node || s.after) END
  FROM climb c
  LEFT JOIN sides s ON NOT c.above AND s.source IS NOT DISTINCT FROM c.source
       AND s.level = c.level AND s.place = c.place
  LEFT JOIN top g ON g.level = 0 AND g.source IS NOT DISTINCT FROM c.source AND NOT c.above
  LEFT JOIN top_sides u ON c.above AND u.level = c.level AND u.place = c.place
  WHERE NOT c.above OR u.level IS NOT NULL),
ends AS (SELECT * FROM climb c WHERE above AND NOT EXISTS (
  SELECT 1 FROM top_sides u WHERE u.level = c.level AND u.place = c.place))
SELECT e.doc_id, e.leaf, b.subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = r.digest AS verified
FROM ends e JOIN subroots b ON b.source IS NOT DISTINCT FROM e.source
JOIN top r ON r.n = 1"""
