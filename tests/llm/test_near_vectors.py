"""Vector links against all pairs in numpy."""

import numpy as np

from tenura.llm import near_vectors as module
from tenura.llm.near_vectors import Tree, _net, block_links, near_vectors


def clusters(seed, n=60, dimensions=12):
    draw = np.random.RandomState(seed)
    base = draw.standard_normal((n, dimensions))
    parts = [base + draw.standard_normal(base.shape) * s for s in (0, 0.05, 0.15, 0.3, 1e-5)]
    rows = np.concatenate([*parts, draw.standard_normal((80, dimensions))])
    return rows.astype(np.float32)[draw.permutation(len(rows))]


def truth(vectors, cosine):
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    label = np.arange(len(unit))
    while True:
        low = np.array([label[row].min() for row in linked])
        if np.array_equal(low, label):
            return linked.sum(axis=1) - 1, label
        label = low


def test_blocks_count_and_connect_like_all_pairs():
    rows = clusters(1).astype(np.float64)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    weights = np.random.RandomState(2).randint(1, 4, len(unit)).astype(np.int64)
    a, b = unit[:200], unit[200:]
    one, two = Tree(a, weights[:200], _net(a)), Tree(b, weights[200:], _net(b))
    across = a @ b.T >= 0.95
    to_a, to_b, _ = block_links(one, two, 0.95)
    assert np.array_equal(to_a, across @ weights[200:])
    assert np.array_equal(to_b, across.T @ weights[:200])
    inside = a @ a.T >= 0.95
    got, _, label = block_links(one, None, 0.95)
    assert np.array_equal(got, inside @ weights[:200] - weights[:200])
    assert np.array_equal(label, truth(a, 0.95)[1])


def test_against_all_pairs(spark, monkeypatch):
    rows = clusters(3)
    links, label = truth(rows, 0.95)
    data = [(i, r.tolist()) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    wanted = [(i, int(links[i]), int(label[i]), label[i] == i) for i in range(len(rows))]
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == wanted
    monkeypatch.setattr(module, "BLOCK", 50)  # many blocks below several top nodes
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == wanted


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (4, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [1.0, 0.0]), (3, None), (1, [0.0, 0.0]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []), (10, [1.0, 0.0, 0.0]),
        (None, [1.0, 0.0]), (11, [1e-38, 1e-39]), (12, [-0.0, 1.0]), (13, [0.0, 1.0]), (4, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "vec_id long, embedding array<float>, rep string, component_id int",
    )
    got = {r["vec_id"]: tuple(r)[1:] for r in near_vectors(df).collect()}
    assert near_vectors(df).count() == len(rows)
    for alone in (3, 1, 5, 6, 7, 8, 10):
        assert got[alone] == (0, alone, True)
    assert got[2] == (3, 2, True) and got[4] == (3, 2, False) and got[11] == (3, 2, False)
    assert got[12] == (1, 12, True) and got[13] == (1, 12, False)
    assert got[None] == (0, None, True)
    assert near_vectors(df.limit(0)).count() == 0
