"""Connected components of an edge table by alternating large-star and
small-star steps; every step is a join and an aggregate over edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from playstream.llm.common import save


FEW = 1 << 20   # edges that one task finishes (16 MB)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _in_task(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of few edges, by one task."""
    schema = edges.schema
    kind = schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        u, v = (np.concatenate([np.asarray(b.column(k)) for b in got] + [np.zeros(0, np.int64)][:not got]) for k in ("u", "v"))
        nodes, number = np.unique(np.concatenate([u, v]), return_inverse=True)
        u, v = np.split(number, 2)
        root = np.arange(len(nodes))
        while (root[u] != root[v]).any():
            a, b = root[u], root[v]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        kind = to_arrow_schema(schema).field("u").type
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(nodes[root], kind)], ["node", "root"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, root {kind}")


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """``edges(a, b)`` of any orderable type -> ``(node, root)``.

    root is the smallest node of the component.  Nodes without an edge to
    another node are absent; loops, repeated and reversed edges are allowed;
    an empty table gives an empty table.  A node with very many edges is
    aggregated before the shuffle and its joins may be split by Spark.  Up to
    ``few`` edges (at the start or after a step) are finished by one task."""
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(e)
    while state[0] > few:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = save(small)
        before, state = state, _state(e)
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    return save(_in_task(e))


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """Of the pairs of indices below ``n``, those that a spanning forest needs."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for i, j in pairs:
        a, b = top(i), top(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept
