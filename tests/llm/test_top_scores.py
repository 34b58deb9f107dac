import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecraft.llm import mtree

from .fixtures_llm import empty, same


def brute(rows, every=50, top=5):
    fine = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in {(i, tuple(v)) for i, v in fine if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in fine if i != q)
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:top])]
    return out


def vectors(n, dim, seed=1):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(7, dim))
    v = (centres[g.integers(0, 7, n)] + 0.3 * g.normal(size=(n, dim))).astype(np.float32)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    same_vector = rows[3][1]
    rows += [(n + i, same_vector) for i in range(n // 3)]  # one very common vector
    rows += [(2 * n, None), (2 * n + 1, [float("nan")] * dim), (2 * n + 50, [float("inf")] * dim), (None, rows[0][1])]
    rows += [(2 * n + 100, [None] + [0.0] * (dim - 1)), (2 * n + 150, [0.0] * dim), rows[50], rows[7], (3 * n, [0.5] * (dim // 2))]
    return rows


@pytest.mark.parametrize(("n", "dim"), [(700, 8), (150, 3)])
def test_equals_brute_force(spark, n, dim):
    rows = vectors(n, dim)
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "vec_id bigint, embedding array<float>, score int, pivot string")
    got = mtree.digest(df.repartition(4))
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    same(got.collect(), brute(rows))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    same(mtree.digest(df).collect(), [(0, 1, 1, 256 * 512)])
    assert mtree.digest(empty(spark, "vec_id bigint, embedding array<float>")).collect() == []
    assert mtree.top_scores(df.where("vec_id = 1"), F.lit(True)).collect() == []


def test_tree_prunes_and_is_exact():
    g = np.random.default_rng(3)
    centres = g.integers(-900, 900, (12, 16))
    v = centres[g.integers(0, 12, 4000)] + g.integers(-20, 20, (4000, 16))
    ids = np.arange(4000)
    tree = mtree.Tree.load(mtree.Tree.build(ids, v).dump())
    random.seed(1)
    for q in random.sample(range(4000), 20):
        best = tree.search(v[q], q, 5, None)
        score = v @ v[q]
        score[q] = -(2**62)
        order = np.lexsort((ids, -score))[:5]
        assert best == [(int(score[i]), int(i)) for i in order]
        assert tree.search(v[q], q, 5, best[-1][0]) == best
    # radii cover what lies below each page
    for page in range(len(tree.leaf)):
        if tree.leaf[page]:
            rows = slice(tree.first[page], tree.first[page] + tree.count[page])
            far = np.sqrt(((tree.points[rows] - tree.pivots[page]) ** 2).sum(1))
            assert np.allclose(far, tree.to_leaf[rows])
            assert far.max() <= tree.radius[page] + 1e-6


@pytest.mark.parametrize("large", [1e6, 1e9, 3e11])
def test_large_components_among_small_ones(spark, large):
    g = np.random.default_rng(4)
    rows = [(i, [float(x) for x in g.normal(size=6)]) for i in range(400)]
    rows += [(1000 + 10 * i, [float(x) for x in g.normal(size=6) * large]) for i in range(12)]
    # 2^31 in each: the row with itself would pass a long, with others not
    rows += [(2000 + i, [large, -large, 0.5, large / 3, 0.0, 1.0]) for i in range(3)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    if any(abs(s) >= 2**63 for *_, s in want):
        with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
            mtree.digest(df).collect()
    else:
        same(mtree.digest(df).collect(), want)


def test_no_score_wraps(spark):
    v = [float(2**31)] * 3
    df = spark.createDataFrame([(0, v), (1, v), (2, [1.0, 0.0, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        mtree.digest(df).collect()
    far = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="no long"):
        mtree.digest(far).collect()
