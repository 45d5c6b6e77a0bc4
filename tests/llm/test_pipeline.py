"""The corpus pipeline, stage by stage against plain versions."""

import brute
import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from test_documents import check_packed

from ebbtide.llm import quality_rules, staging


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}
    (_, quality), (_, near), (_, repeats), (_, packing) = corpus_pipeline.STAGES
    kept = staging.keep(quality(spark, docs, folder))
    assert kept.columns == docs.columns
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.quality_votes(docs).collect()}
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert rows == {d: r["text"] for d, r in before.items() if verdict[d]}
    assert all(not brute.quality_counts(t)["base_failed"] for t in rows.values())

    firsts = staging.keep(near(spark, kept, folder))
    assert firsts.columns == docs.columns
    groups = brute.simhash_groups(list(rows.items()))
    want = {d: t for d, t in rows.items() if groups[d][1] == d}
    assert {r["doc_id"]: r["text"] for r in firsts.collect()} == want

    cut = staging.keep(repeats(spark, firsts, folder))
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r for r in cut.collect()}
    plain = brute.substring_dedup(list(want.items()))
    assert texts.keys() == want.keys()
    for d, r in texts.items():
        n, removed, _ = plain[d]
        assert len(brute.words(r["text"])) == n - removed
        assert r["n_chars"] == (len(r["text"]) if removed else before[d]["n_chars"])
        assert removed or r["text"] == want[d]

    out = packing(spark, cut, folder).collect()
    check_packed(out, [(d, r["text"]) for d, r in texts.items()], 1024)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r[:5] for r in whole) == sorted(r[:5] for r in out)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_empty_and_repeated_rows(spark, folder, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert stage[1](spark, docs.limit(0), folder).count() == 0
    nulls = spark.createDataFrame([(None,) * 5] * 2, docs.schema)
    assert stage[1](spark, nulls, folder).columns == docs.columns
