import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives as neg


@pytest.mark.parametrize("inner,largest", [(1, 1), (3, 7), (64, 300), (64, 30000), (5, 2**27), (1500, 40), (2500, 60000)])
def test_products_are_exact(inner, largest):
    rng = np.random.default_rng(inner)
    a, b = (rng.integers(-largest, largest + 1, (n, inner)) for n in (7, 9))
    a[0], b[0], b[1] = largest, largest, -largest
    residues = neg.Residues(inner, inner * largest * largest)
    want = [[sum(x * y for x, y in zip(r, s)) for s in b.tolist()] for r in a.tolist()]
    assert residues.product(residues.split(a), residues.split(b)).tolist() == want
    assert all(min(inner, neg.INNER) * (p // 2) ** 2 < neg.EXACT for p in residues.primes)


def plain(rows, is_anchor, positives=5, negatives=3):
    """Every anchor against every row, one by one; ``rows`` in stored order are told apart by place."""
    out = []
    key = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    for i, (a, la, va) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), r, j, label) for j, (r, label, v) in enumerate(rows)]
        for ps, p, _, _ in sorted((s for s in scored if s[3] == la and s[2] != i), key=key)[:positives]:
            near = [s for s in scored if s[3] != la and 50 * ps <= 100 * s[0] <= 95 * ps]
            out += [(a, p, k + 1, s[1], ps, s[0]) for k, s in enumerate(sorted(near, key=key)[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, is_anchor):
    frame = spark.createDataFrame(rows, "id long, label long, values array<long>")
    got = neg.hard_negatives(frame, is_anchor)
    return sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_one_by_one(spark, monkeypatch, seed):
    for name, n in (("ROWS", 16), ("ANCHORS", 3), ("SLICE", 2), ("GROUP", 2)):
        monkeypatch.setattr(neg, name, n)
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.randrange(-4, 9) for _ in range(3)]) for i in range(150)]
    rows += [(None, 1, [3, 3, 3]), (None, 0, [2, 2, 2]), (200, 0, []), (201, 1, [5]), (202, 7, [1, 1, 1])]
    rows += [(300, 1, [4, 4, 4])] * 3 + [(50, 0, [1, 2, 3])]  # repeated rows, a repeated anchor id
    assert mined(spark, rows, F.col("id") % 10 == 0) == plain(rows, lambda a: a is not None and a % 10 == 0)


def test_one_vector_on_most_rows(spark):
    rows = [(i, i % 2, [3, 4]) for i in range(300)] + [(1000 + i, i % 3, [3, i]) for i in range(5)]
    assert mined(spark, rows, F.col("id") % 50 == 0) == plain(rows, lambda a: a % 50 == 0)


def test_awkward_rows(spark):
    assert mined(spark, [], F.col("id") % 10 == 0) == []
    assert mined(spark, [(1, 0, [1])], F.col("id") % 10 == 0) == []
    assert mined(spark, [(10, 0, [1]), (11, 1, [1])], F.col("id") % 10 == 0) == []
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(10, 0, [2**40])], F.col("id") % 10 == 0)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 0, [0.5]), (2, None, [0.5]), (3, 0, None), (4, 0, [0.5, None]), (5, 0, [nan]), (6, 0, [-inf]), (7, 0, [])]
    frame = spark.createDataFrame(rows, "id long, label int, v array<float>")
    kept = frame.where(neg.usable(F.col("label"), F.col("v"))).select("id", neg.scaled(F.col("v")).alias("v")).collect()
    assert sorted((r.id, r.v) for r in kept) == [(1, [128]), (7, [])]
    assert spark.sql("SELECT array(-0.001D, 0.0039D) AS v").select(neg.scaled(F.col("v")).alias("v")).first().v == [-1, 0]
