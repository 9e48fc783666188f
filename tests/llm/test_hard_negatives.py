import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, at long, place string"


def expected(rows, every, positives=5, negatives=3, least=50, most=95):
    usable = [(i, x, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, x in rows if None not in (i, v, x) and v and None not in v and np.isfinite(v).all()]
    out = []
    for i, x, v in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, y) for j, y, w in usable if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == x][:positives]:
            hard = [(-s, k) for s, k, y in scored if y != x and least * -p <= 100 * -s <= most * -p]
            out += [(i, j, r, k, -p, s) for r, (s, k) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def check(spark, rows, every=5, **options):
    table = spark.createDataFrame([(*r, 7, 8, "x") for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(table, F.col("vec_id") % every == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, found.collect()))
    assert got == expected(rows, every, **options)
    return got


def clustered(rng, n, dims, labels=4):
    centres = rng.normal(size=(n // 20 + 1, dims))
    vectors = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dims)) * 0.5
    return [(i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(0, labels))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("dims", [1, 3, 16, 37])
def test_against_all_pairs(spark, dims):
    found = check(spark, clustered(np.random.default_rng(dims), 400, dims))
    assert found or dims == 1


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD_BYTES", 2000)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(hard_negatives, "ROWS", 20)
    check(spark, clustered(np.random.default_rng(1), 500, 12), positives=3, negatives=7, least=-20, most=90)


def test_many_equal_scores(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(0, 3, 4).astype(float).tolist(), int(i % 3)) for i in range(300)]
    check(spark, rows, every=7)


def test_repeated_rows_count_as_often_as_they_occur(spark):
    rows = clustered(np.random.default_rng(3), 60, 5, labels=2)
    check(spark, rows + rows[:30] + rows[:10], every=6)


def test_a_label_may_hold_most_rows(spark):
    rows = clustered(np.random.default_rng(5), 300, 8)
    check(spark, [(i, v, 0 if i % 10 else x) for i, v, x in rows])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.5], [0.9, 0.0], [0.0, 0.0], None, [nan, 1.0], [1.0, None], [1.0, 0.1], [1.0, 0.0, 0.0], [2.0, 0.0], [inf, 1.0], [], [-0.0, 0.0], [-1.0, 0.3], [0.7, 0.2, 0.1]]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)] + [(20, [1.0, 1.0], None), (None, [1.0, 0.0], 0), (None, None, None), (0, [1.0, 0.0], 1)]
    check(spark, rows, every=1)
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("vec_id") % 5 == 0).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        check(spark, [(0, [1e30, 1.0], 0), (1, [1.0, 1.0], 1)])


def test_bounds_leave_few_rows_to_the_last_dimensions():
    rng = np.random.default_rng(6)
    vectors = hard_negatives.whole(np.stack([v for _, v, _ in clustered(rng, 4000, 64)]))
    shard = hard_negatives.Shard(np.arange(4000), [0] * 4000, vectors)
    left = []

    def keep(least, greatest):
        left.append(len(least))
        return greatest >= hard_negatives.Best(5).bar(least)

    rows, scores = shard.scan(vectors[0], shard.others(0, 0, True), keep)
    exact = vectors @ vectors[0]
    assert (scores == exact[rows]).all() and set(np.argsort(-exact[1:], kind="stable")[:5] + 1) <= set(rows.tolist())
    assert left[0] == 3999 and left[-1] < 400 and left == sorted(left, reverse=True)
