"""Boosted trees: which rows a pass follows, and in what portions."""

import numpy as np
import pyarrow as pa

from ebbtide.ml import boosting


def test_trees_follow_only_rows_that_count(monkeypatch):
    draw = np.random.default_rng(3)
    n = 4000
    bins = draw.integers(0, boosting.BINS, (n, 3)).astype(np.uint8)
    fold = draw.integers(0, 4, n).astype(np.int32)
    label, seed = (draw.random(n) < 0.4).astype(float), draw.integers(0, 1 << 60, n)
    margins = draw.normal(size=(n, 2))
    chunk = boosting.Chunk(bins.ravel(), boosting.row_starts(bins), bins.T.copy(), label, fold, seed,
                           margins)
    grown, old = boosting.Nodes(), boosting.Nodes()
    frontier = list(grown.split(0, 1, 11.0))
    old.split(0, 2, 7.0)
    old.value = [0.0, -0.25, 0.5]
    work = boosting.Work(1, 2, 0.5, 9, [old.arrays(np.uint8)], grown.arrays(np.uint8), frontier,
                         np.array([0, 2]))
    followed, places = [], boosting.places
    monkeypatch.setattr(boosting, "places", lambda tree, x, starts: (
        followed.append(len(starts)), places(tree, x, starts))[1])
    found = work.sums(chunk, judged=False)
    use = (fold != 2) & (boosting.uniform(seed, 9) < 0.5)
    assert followed == [use.sum()] * 2
    p = boosting.chance(margins[:, 1] + np.where(bins[:, 2] <= 7, -0.25, 0.5))
    grid = found[2:].reshape(2, 2, 2, boosting.BINS)
    for spot, side in enumerate((bins[:, 1] <= 11, bins[:, 1] > 11)):
        for i, c in enumerate((0, 2)):
            for b in (0, 7, 31):
                at = use & side & (bins[:, c] == b)
                np.testing.assert_allclose(grid[i, 0, spot, b], (p - label)[at].sum(), atol=1e-9)
                np.testing.assert_allclose(grid[i, 1, spot, b], (p * (1 - p))[at].sum(), atol=1e-9)


def test_batches_are_put_together(monkeypatch):
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 5)
    batches = [pa.RecordBatch.from_pydict({"a": list(range(k))}) for k in (2, 2, 2, 6, 1)]
    joined = list(boosting._joined(iter(batches)))
    assert [len(b) for b in joined] == [6, 6, 1]
    assert [v for b in joined for v in b.column(0).to_pylist()] == [
        v for b in batches for v in b.column(0).to_pylist()]
