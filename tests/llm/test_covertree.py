"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from playstream.llm import covertree

#: with extra columns of names that the operator uses itself
ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                     T.StructField("unit", T.StringType()), T.StructField("node", T.StringType()), T.StructField("cls", T.LongType())])


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", None, 1) for i, v, label in rows], ROWS)


def plainly(rows, least):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)
    units = [unit(v) if label is not None else None for _, v, label in rows]
    n, link = len(rows), np.zeros((len(rows), len(rows)), bool)
    groups = {}
    for k, u in enumerate(units):
        if u is not None:
            groups.setdefault((rows[k][2], len(u)), []).append(k)
    for ks in groups.values():
        u = np.stack([units[k] for k in ks])
        link[np.ix_(ks, ks)] = u @ u.T >= least
    np.fill_diagonal(link, False)
    ids = np.array([np.inf if i is None else i for i, _, _ in rows])
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(link, low[None, :], np.inf).min(axis=1, initial=np.inf))
        if (new == low).all():
            break
        low = new
    out = [(i, int(link[k].sum()), None if low[k] == np.inf else int(low[k]), i is not None and low[k] == i) for k, (i, _, _) in enumerate(rows)]
    return sorted(out, key=str)


def check(spark, rows, least=0.93, **more):
    got = [tuple(r) for r in covertree.near_vectors(table_of(spark, rows), least, **more).collect()]
    assert sorted(got, key=str) == plainly(rows, least)


def random_rows(seed, n, dims=8, spread=(0.02, 0.3), hubs=6, labels=3):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(hubs, dims))
    v = at[rng.integers(hubs, size=n)] + rng.choice(spread, n)[:, None] * rng.normal(size=(n, dims))
    return [(int(i), [float(np.float32(x)) for x in v[i] * rng.choice([1, 2, 1e-3])], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("least,leaf,fanout", [(0.93, 2048, 128), (0.93, 40, 4), (0.99, 25, 128), (0.5, 30, 8)])
def test_equals_all_pairs(spark, least, leaf, fanout):
    check(spark, random_rows(int(100 * least) + leaf, 600), least, leaf=leaf, fanout=fanout)


def test_a_crowd_in_one_place_with_few_outside(spark):
    rows = random_rows(1, 500, dims=16, spread=(1e-4,), hubs=1, labels=1) + [(1000 + i, v, k) for i, v, k in random_rows(2, 100, dims=16, spread=(1.0,), labels=1)]
    check(spark, rows, leaf=30, fanout=8)


def test_nodes_that_cannot_be_split_by_place_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(covertree, "ROUNDS", 0)
    check(spark, random_rows(5, 300, labels=1), leaf=20, fanout=4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1),
            (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1),
            (13, [-0.0, -1.0], 1), (14, [0.0, -1.0], 1), (15, [3e38, 3e38], 1), (16, [1e-38, 1e-38], 1)]
    check(spark, rows)
    assert covertree.near_vectors(table_of(spark, [])).collect() == []


def test_no_bound_rules_out_or_links_wrongly():
    rng = np.random.default_rng(0)
    for dims, spread in ((3, 0.05), (3, 0.5), (24, 0.06), (24, 1.0)):
        u = rng.normal(size=(1, dims)) + spread * rng.normal(size=(300, dims))
        u /= np.linalg.norm(u, axis=1)[:, None]
        x, y = (covertree.Block(covertree._block([{"cls": i, "copies": 1, "unit": v.tobytes()} for i, v in enumerate(part)], 0.374)) for part in (u[:180], u[180:]))
        for level, size in enumerate(x.sizes):   # nested, covering, separated
            node = x.nodes(level)
            assert (node[:size] == np.arange(size)).all()
            far = np.linalg.norm(x.units - x.units[node], axis=1)
            assert (far <= x.radii[level][node] + 1e-6).all()
            gaps = np.linalg.norm(x.units[:size, None] - x.units[None, :size], axis=2) + 9 * np.eye(size)
            assert level == len(x.sizes) - 1 or size == 1 or gaps.min() > 2.0 / 2 ** level - 1e-6
        assert (covertree.linked(x, y, 0.93) == (x.units @ y.units.T >= 0.93)).all()
