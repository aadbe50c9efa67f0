import random

from playstream.llm.common import discard, erase, recorded, save
from playstream.llm.components import components, forest


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(df, few=-1).collect()}
    assert got == {r.node: r.root for r in components(df).collect()} == {r.node: r.root for r in components(df, few=20).collect()}
    up = {x: x for p in pairs for x in p if p[0] != p[1]}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a != b:
            up[max(top(a), top(b))] = min(top(a), top(b))
    assert got == {x: top(x) for x in up}


def test_shapes(spark):
    check(spark, [])
    check(spark, [(3, 3)])
    check(spark, [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)])
    rng = random.Random(1)
    check(spark, [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)] * 2)


def test_forest():
    assert forest(4, [(0, 1), (1, 2), (0, 2), (3, 3), (2, 3)]) == [(0, 1), (1, 2), (2, 3)]


def test_saved_tables_can_go(spark):
    import os
    paths = []
    with recorded(paths):
        a, b = save(spark.range(3)), save(spark.range(4))
    assert [os.path.isdir(p.removeprefix("file:")) for p in paths] == [True, True] and b.count() == 4
    erase(a)
    assert not os.path.isdir(paths[0].removeprefix("file:"))
    kept = list(paths)
    discard(spark, paths)
    assert paths == [] and not any(os.path.isdir(p.removeprefix("file:")) for p in kept)
