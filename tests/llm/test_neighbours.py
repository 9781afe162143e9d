"""Numbers of hash functions and probes against brute force."""

import numpy as np
import pytest

from areacast.llm import neighbours
from areacast.llm.common import importable


def recall(got, x, ids, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids:
        score = unit @ unit[q]
        score[q] = -2
        hits += len(found[q] & set(np.argsort(-score)[:k].tolist()))
    return hits / (k * len(ids))


@pytest.mark.parametrize("clusters", [0, 400])
def test_probes_reach_the_recall(spark, clusters):
    """Clustered vectors need few visits; vectors of random directions need many, and get them."""
    importable(spark)
    r = np.random.default_rng(5)
    n, size = 8000, 16
    x = r.normal(size=(n, size))
    if clusters:
        x = r.normal(size=(clusters, size))[r.integers(0, clusters, n)] + 0.05 * x
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    asked = table.where("vec_id % 40 = 0")
    classes = table.withColumnRenamed("vec_id", "class")
    functions, probes = neighbours.tuned(classes, classes.where("class % 40 = 0"), n, 5)
    assert 0 <= functions <= np.log2(n / 64)
    if clusters:
        assert functions >= 3 and probes < 200
    assert recall(neighbours.nearest(table, asked).collect(), x, range(0, n, 40)) >= 0.9


def test_sampled_neighbours_are_exact(spark):
    importable(spark)
    r = np.random.default_rng(6)
    x = r.normal(size=(300, 5))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())] + [(900, [1.0, 2.0]), (901, [2.0, 1.0])], "class long, embedding array<double>").repartition(3)
    got = neighbours._sampled_neighbours(table, [(7, x[7].tolist()), (900, [1.0, 2.0])], 4)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    score = unit @ unit[7]
    score[7] = -2
    assert sorted(got[7]) == sorted(x[np.argsort(-score)[:4]].tolist()) and got[900] == [[2.0, 1.0]]


def test_other_columns_do_not_matter(spark):
    importable(spark)
    table = spark.createDataFrame([(1, [1.0, 0.0], 5, 6, "a"), (2, [1.0, 0.1], 7, 8, "b"), (3, [0.0, 1.0], 9, 10, "c")], "vec_id long, embedding array<double>, class int, `key` int, Score string")
    got = neighbours.nearest(table, table.where("vec_id = 1")).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(1, 1, 2), (1, 2, 3)]
