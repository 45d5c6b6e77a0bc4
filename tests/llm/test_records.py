"""Manifest, conversation repair and nearest neighbours against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import merkle, registered, repair, small_world

DOCS = "doc_id long, source string, lang string, n_chars long, text string, key int, digest int"
CONVERSATIONS = "conv_id long, turn long, role string, text string, kind string, name string"


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], DOCS)


def test_manifest_of_awkward_rows(spark):
    rows = [(i, "hot", "en", i % 7, None if i % 11 == 0 else f"Text {i} É") for i in range(700)]
    rows += [(i, f"s{i}", None, None, "Alone" * (i % 3)) for i in range(40)]
    rows += [(i, None, "de", 1, "X" * 5000) for i in range(17)]
    rows += [(5, "hot", "en", 1, "again"), (5, "hot", "en", 1, "again"), (None, "hot", "", 0, ""),
             (None, None, None, None, None), (-1, "", "en", 2, "empty source")]
    names = ("doc_id", "source", "lang", "n_chars", "text")
    want = sorted(brute.manifest([dict(zip(names, r)) for r in rows]), key=str)
    got = merkle.manifest_digests(docs_of(spark, rows))
    assert as_set(got) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_sizes(spark):
    sizes = (1, 2, 16, 17, 256, 257, 4097)
    listed = [(i, f"of {n}", "en", i, f"Text {i}") for n in sizes for i in range(n)]
    names = ("doc_id", "source", "lang", "n_chars", "text")
    want = sorted(brute.manifest([dict(zip(names, r)) for r in listed]), key=str)
    assert as_set(merkle.manifest_digests(docs_of(spark, listed))) == want
    one = merkle.manifest_digests(docs_of(spark, listed[:1])).collect()
    assert [tuple(r) for r in one] == brute.manifest([dict(zip(names, listed[0]))])
    assert merkle.manifest_digests(docs_of(spark, [])).count() == 0


def test_small_fanout_has_many_stored_levels(spark):
    rows = spark.range(300).select(F.col("id"), F.lit("g").alias("group"))
    made = merkle.build(rows, F.sha2(F.col("id").cast("string"), 256), key="id", group="group",
                        fanout=2)
    assert len(made.levels) == 5  # two to the ninth leaves, every second level
    proofs = made.proofs()
    wrong = proofs.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root"))
    assert proofs.count() == 300 and not wrong.count()
    assert proofs.where(F.size("path") != 9).count() == 0


def conversations_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "n") for r in rows], CONVERSATIONS)


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(3)
    texts = ["a.", "b!", "c", "", " \n", "d?\t", None, "x", "y.", "zz.", "q? ", "É", "w" * 30_000]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c or None, draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts))
            for c in range(60) for _ in range(draw.choice([1, 2, 3, 5, 9, 60]))]
    return rows + [(70, i, ["user", "assistant"][i % 2], f"Turn {i}.") for i in range(400)]


def test_repairs_of_damaged_conversations(spark, talk):
    got = repair.conversation_repairs(conversations_of(spark, talk))
    want = brute.conversations(brute.damaged(talk), {r[0] for r in talk})
    assert as_set(got) == want
    empty = conversations_of(spark, []).drop("text").withColumn("text", F.lit(None))
    assert repair.conversation_repairs(empty).count() == 0


@pytest.mark.parametrize("bits", [0, 2])
def test_long_conversations_in_chunks(spark, talk, bits):
    rows = [tuple(" " if i > 1 and x is None else x for i, x in enumerate(r)) for r in talk]
    got = repair.repair_report(conversations_of(spark, talk), bits=bits)
    assert as_set(got) == brute.conversations(rows, set())


def test_repaired_rows_follow_the_grammar(spark, talk):
    made = repair.repaired_rows(conversations_of(spark, talk), bits=2).collect()
    by = {}
    for row in sorted(made, key=lambda r: r["position"]):
        by.setdefault(row["conv_id"], []).append(row["role"][:1])
    for initials in by.values():
        text = "".join(initials).removeprefix("s")
        assert text == "ua" * (len(text) // 2)


def test_automaton_shares_suffixes():
    automaton = repair.SuffixAutomaton()
    for signature in sorted(["ua", "sua", "uaua", "Uaua", "xuaua", "uaxua"], key=lambda s: s[::-1]):
        automaton.node(signature, None)
    assert automaton.made == len({s[i:] for s in ["ua", "sua", "uaua", "Uaua", "xuaua", "uaxua"]
                                  for i in range(len(s))})


VECTORS = "vec_id long, embedding array<float>, label int, k1 int, ids string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], VECTORS)


def nearest(rows, k):
    """Every query against every row, in the order of the columns of the operator."""
    out = []
    rows = [(i, np.asarray(v, np.float64)) for i, v in {(i, tuple(v)) for i, v in rows
            if v and None not in v and np.isfinite(v).all() and np.any(v)}]
    dot = lambda a, b: np.cumsum(a * b)[-1]
    for query, a in rows:
        if query is None or query % 50:
            continue
        scored = sorted((-(dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))), other)
                        for other, b in rows if other != query and len(a) == len(b))
        out += [(query, rank + 1, other, -score)
                for rank, (score, other) in enumerate(scored[:k])]
    return sorted(out, key=str)


def test_neighbours_of_awkward_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    copy = rows[10][1]
    rows += [(300 + i, copy) for i in range(200)] + [(10, copy)]
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [None] + [1.0] * 7),
             (604, [float("nan")] * 8), (605, [float("inf")] * 8), (650, [1.0, 2.0]),
             (651, [2.0, 4.0]), (700, [3.0, 4.0, 5.0]), (652, [2 * x for x in copy])]
    df = vectors_of(spark, rows)
    got = small_world.nearest_neighbours(df.where("vec_id % 50 = 0"), df, k=5)
    assert as_set(got) == nearest(rows, 5)
    none = df.limit(0)
    assert small_world.nearest_neighbours(none, none).count() == 0


def test_shards_and_blocks_are_merged(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(6).astype(np.float32).tolist()) for i in range(900)]
    df = vectors_of(spark, rows)
    got = small_world.nearest_neighbours(df.where("vec_id % 50 = 0"), df, k=3, shard_rows=100,
                                         query_rows=4)
    assert as_set(got) == nearest(rows, 3)


def test_no_side_of_the_pairs_is_broadcast(spark, monkeypatch):
    draw = np.random.default_rng(9)
    rows = [(i, draw.standard_normal(4).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, draw.standard_normal(3).astype(np.float32).tolist()) for i in range(300)]
    df = vectors_of(spark, rows)
    plans, searched = [], small_world.searched

    def spy(pairs, *args):
        met = pairs.select("size", "shard", F.explode("queries.k1").alias("k1"))
        assert met.count() == met.distinct().count() == 9 * 18
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return searched(pairs, *args)

    monkeypatch.setattr(small_world, "searched", spy)
    got = small_world.nearest_neighbours(df.where("vec_id % 50 = 0"), df, k=2, shard_rows=100,
                                         query_rows=2)
    assert as_set(got) == nearest(rows, 2)
    assert len(plans) == 1 and "Broadcast" not in plans[0]


def crowded(kind, rows):
    draw = np.random.default_rng(7)
    noise = draw.standard_normal((rows, 64))
    if kind == "hot":
        noise[:rows // 3] = 0.65 * noise[:rows // 3] + draw.standard_normal(64)
    if kind == "tight":
        noise[:rows // 3] = 0.001 * noise[:rows // 3] + draw.standard_normal(64)
    if kind == "groups":
        centres = draw.standard_normal((rows // 100, 64))
        noise = centres[draw.integers(0, len(centres), rows)] + 0.02 * noise
    return noise


@pytest.mark.parametrize("kind", ["even", "hot", "tight", "groups"])
def test_recall_of_a_shard(kind):
    vectors = small_world.units(crowded(kind, 4000))
    queries = vectors[::40]
    found = small_world.Graph.build(vectors).search(queries, small_world.SEARCH_WIDTH)[:, :6]
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :6]
    recall = np.mean([len(set(a) & set(b)) / 6 for a, b in zip(found, best)])
    assert recall >= 0.97


def test_recall_of_the_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"])
            for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = as_set(registered.op13_small_world(spark, folder))
    want = nearest(rows, 5)
    assert len(got) == len(want)
    assert len(set(got) & set(want)) >= 0.9 * len(want)
