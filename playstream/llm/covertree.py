"""Near-duplicate vectors by dual traversal of a cover tree.

1. Vectors become unit vectors; equal ones of a label are one class.
2. Upper levels, in Spark: a node with too many classes gets centres (a net of
   half the radius, out of a sample of it), each class goes to the nearest,
   and the covering radius of every new node is the largest distance measured.
3. Lower levels, in tasks: a leaf's classes, in farthest-first order, are
   nested nets of halving radii, as each net is a prefix of that order.
4. Dual traversal: pairs of nodes meet from the root on, first as rows of a
   table, then inside pairs of leaves.  A pair whose centres are farther apart
   than the bound and both covering radii is pruned; one that is near enough
   for all it holds is linked as a whole; what is left at the bottom is
   verified by cosine.
5. A pair of leaves returns a row per linked class (its links' number, the
   smallest class reached), never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import save, table
from playstream.llm.components import components

LEAF = 2048        # classes of a leaf, at most
FANOUT = 128       # children of a node, at most
ROUNDS = 24        # levels after which a node that is still too large is dealt out evenly
_BLOCK = 4096      # classes that a task assigns to centres at once, about
_SLACK = 1e-6      # of distances, for rounding; whatever is closer to a bound than this is looked at further down


def _far(cosine: np.ndarray) -> np.ndarray:
    """Distance of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes; null for what links with nothing."""
    for b in batches:
        column, out = b.column("embedding"), [None] * b.num_rows
        sizes = np.array([-1 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            flat = column.take(pa.array(rows)).flatten()
            v = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)   # null becomes NaN
            most = np.abs(v).max(axis=1)
            good = np.isfinite(most) & (most > 0)   # NaN and infinite components show in the largest one
            v = v[good] / most[good, None]
            v = v / np.sqrt((v * v).sum(axis=1))[:, None] + 0.0   # no negative zeros
            for row, u in zip(rows[good].tolist(), v.astype("<f8")):
                out[row] = u.tobytes()
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "unit"])


def _farthest_first(u: np.ndarray, stop: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in farthest-first order, and every row's distance from the
    ones before it; ends at ``most`` rows or when all rows are within ``stop``."""
    order, reach = [0], [np.inf]
    near = _far(u @ u[0])
    near[0] = 0.0
    while len(order) < min(most, len(u)):
        j = int(near.argmax())
        if near[j] <= stop:
            break
        order.append(j)
        reach.append(float(near[j]))
        np.minimum(near, _far(u @ u[j]), out=near)
        near[j] = 0.0
    return np.array(order), np.array(reach)


def _net(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a node's sample, centres farther apart than half the sample's radius."""
    for b in batches:
        out: dict[str, list] = {"node": [], "number": [], "center": []}
        for node, sample, most in zip(b.column("node").to_pylist(), b.column("sample").to_pylist(), b.column("most").to_pylist()):
            u = _matrix(sorted(set(sample)))
            order, reach = _farthest_first(u, 0.0, most)
            if len(reach) > 1:
                order = order[reach > reach[1] / 2]
            for k, j in enumerate(order.tolist() if len(order) > 1 else [0] * most):   # one place only: its classes are dealt out
                for name, x in zip(out, (node, k, u[j].tobytes())):
                    out[name].append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out["node"], pa.string()), pa.array(out["number"], pa.int32()), pa.array(out["center"], pa.binary())], list(out))


def _assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every class of a block goes to its nearest centre (of equal centres: to any one)."""
    for b in batches:
        for node, members, centers in zip(*(b.column(k).to_pylist() for k in ("node", "members", "centers"))):
            u, c = _matrix([m["unit"] for m in members]), _matrix([x["center"] for x in centers])
            cosine = u @ c.T
            best = cosine.argmax(axis=1)
            if (c == c[0]).all():
                best = np.array([m["deal"] for m in members]) % len(c)
            yield pa.RecordBatch.from_arrays([pa.array([f"{node}.{centers[k]['number']}" for k in best.tolist()], pa.string()), pa.array([m["cls"] for m in members], pa.int64()),
                                              pa.array([m["copies"] for m in members], pa.int64()), pa.array([m["unit"] for m in members], pa.binary()),
                                              pa.array(_far(cosine[np.arange(len(u)), best]))], ["node", "cls", "copies", "unit", "far"])


def _upper(classes: DataFrame, leaf: int, fanout: int) -> tuple[DataFrame, DataFrame | None]:
    """Leaves' classes ``(node, cls, copies, unit)`` and nodes ``(parent, node,
    center, radius)``; without a node of two levels there is no second table."""
    at, leaves, nodes = classes, [], []
    for level in count():
        sizes = save(at.groupBy("node").agg(F.count("*").alias("n")))
        big = sizes.where(F.col("n") > leaf)
        if big.isEmpty():
            leaves.append(at)
            break
        leaves.append(at.join(sizes.where(F.col("n") <= leaf), "node", "left_semi"))
        big = big.withColumn("most", F.least(F.lit(fanout), F.greatest(F.lit(8), F.ceil(2 * F.col("n") / leaf))).cast("int"))
        mine = at.join(big, "node")
        # about four times as many as children; past the last round one place, so that classes are dealt out
        rate = F.lit(1 << 42) * F.col("most") / F.col("n") if level < ROUNDS else F.lit(0.0)
        drawn = F.when(F.pmod(F.xxhash64("cls", F.lit(level)), F.lit(1 << 40)) < rate, F.col("unit"))
        sample = mine.groupBy("node", "most").agg(F.concat(F.collect_list(drawn), F.array(F.min("unit"))).alias("sample"))
        centers = save(sample.select("node", "most", "sample").mapInArrow(_net, "node string, number int, center binary"))
        blocks = (mine.groupBy("node", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / _BLOCK)).alias("part"))
                  .agg(F.collect_list(F.struct("cls", "copies", "unit", F.pmod(F.xxhash64("cls", F.lit(-level)), F.lit(1 << 31)).alias("deal"))).alias("members")))
        lists = centers.groupBy("node").agg(F.collect_list(F.struct("number", "center")).alias("centers"))
        given = save(blocks.join(lists, "node").mapInArrow(_assigned, "node string, cls long, copies long, unit binary, far double"))
        radii = given.groupBy("node").agg(F.max("far").alias("radius"))
        nodes.append(save(centers.select(F.col("node").alias("parent"), F.concat_ws(".", "node", "number").alias("node"), "center").join(radii, "node")
                          .select("parent", "node", "center", "radius")))
        at = given.drop("far")
    whole, tree = leaves[0], nodes[0] if nodes else None
    for x in leaves[1:]:
        whole = whole.unionByName(x)
    for x in nodes[1:]:
        tree = tree.unionByName(x)
    return whole, tree


def _met(bound: float):
    """Pairs of children that no covering-radius bound rules out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for a, b, xs, ys in zip(*(batch.column(k).to_pylist() for k in ("a", "b", "xs", "ys"))):
                far = _far(_matrix([x["center"] for x in xs]) @ _matrix([y["center"] for y in ys]).T)
                reach = np.add.outer([x["radius"] for x in xs], [y["radius"] for y in ys])
                for i, j in np.argwhere(far <= bound + reach + _SLACK).tolist():
                    if a != b or xs[i]["node"] <= ys[j]["node"]:
                        out_a.append(xs[i]["node"])
                        out_b.append(ys[j]["node"])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.string()), pa.array(out_b, pa.string())], ["a", "b"])
    return run


def _leaf_pairs(roots: DataFrame, tree: DataFrame | None, bound: float) -> DataFrame:
    """``(a, b)``: pairs of leaves that may hold links, by traversal from the roots."""
    pairs = roots.select(F.col("node").alias("a"), F.col("node").alias("b"))
    if tree is None:
        return pairs
    kids = tree.groupBy("parent").agg(F.collect_list(F.struct("node", "center", "radius")).alias("kids"))   # at most FANOUT
    itself = tree.join(kids.select(F.col("parent").alias("node")), "node", "left_anti").select(
        F.col("node").alias("parent"), F.array(F.struct("node", "center", "radius")).alias("kids"))
    inner = save(kids.withColumn("inner", F.lit(True)).unionByName(itself.withColumn("inner", F.lit(False))))
    side = lambda k, xs: inner.select(F.col("parent").alias(k), F.col("kids").alias(xs), F.col("inner").alias(f"{k}_inner"))
    done = []
    while True:
        # a root that is a leaf has no row in ``inner``
        known = pairs.join(side("a", "xs"), "a", "left").join(side("b", "ys"), "b", "left")
        open_ = F.coalesce("a_inner", F.lit(False)) | F.coalesce("b_inner", F.lit(False))
        done.append(save(known.where(~open_).select("a", "b")))
        pairs = save(known.where(open_).select("a", "b", "xs", "ys").mapInArrow(_met(bound), "a string, b string"))
        if pairs.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


class Block:
    """A leaf's classes as nested nets: level k is the first ``sizes[k]`` rows,
    its nodes cover their descendants within ``radii[k]``."""

    FIELDS = "cls binary, copies binary, units binary, sizes binary, parents binary, radii binary"
    KINDS = {"cls": "<i8", "copies": "<i8", "units": "<f8", "sizes": "<i8", "parents": "<i4", "radii": "<f8"}

    def __init__(self, row: dict) -> None:
        for k, kind in self.KINDS.items():
            setattr(self, k, np.frombuffer(row[k], kind))
        self.units = self.units.reshape(len(self.cls), -1)
        cuts = np.cumsum(self.sizes)[:-1]
        self.parents, self.radii = np.split(self.parents, cuts), np.split(self.radii, cuts)

    def nodes(self, level: int) -> np.ndarray:
        """Every class's node of a level."""
        at = np.arange(len(self.cls))
        for k in range(len(self.sizes) - 1, level, -1):
            at = self.parents[k][at]
        return at


def _block(members: list[dict], bound: float) -> dict:
    """Columns of a ``Block``."""
    members = sorted(members, key=lambda m: m["cls"])
    u = _matrix([m["unit"] for m in members])
    order, reach = _farthest_first(u, bound / 8, len(u))
    rest = np.setdiff1d(np.arange(len(u)), order)
    order, reach = np.concatenate([order, rest]), np.concatenate([reach, np.zeros(len(rest))])
    u = np.ascontiguousarray(u[order])
    radius, sizes = 2.0, []
    while radius > bound / 4:   # a net of each halved radius, then the classes
        sizes.append(max(1, int((reach > radius).sum())))
        radius /= 2
    sizes.append(len(u))
    parents, radii = [np.zeros(sizes[0], np.int32)], []
    for above, n in zip(sizes, sizes[1:]):
        parent = np.arange(n, dtype=np.int32)
        if n > above:
            parent[above:] = (u[above:n] @ u[:above].T).argmax(axis=1)
        parents.append(parent)
    node = np.arange(len(u))
    for k in range(len(sizes) - 1, -1, -1):
        most = np.zeros(sizes[k])
        far = _far((u * u[node]).sum(axis=1))
        far[node == np.arange(len(u))] = 0.0   # a node of its own
        np.maximum.at(most, node, far)
        radii.insert(0, most)
        node = parents[k][node]
    arrays = {"cls": [members[i]["cls"] for i in order], "copies": [members[i]["copies"] for i in order], "units": u, "sizes": sizes,
              "parents": np.concatenate(parents), "radii": np.concatenate(radii)}
    return {k: np.asarray(x).astype(Block.KINDS[k]).tobytes() for k, x in arrays.items()}


def linked(x: Block, y: Block, least: float) -> np.ndarray:
    """Which classes of two leaves link: level by level, both at once."""
    bound = _far(np.float64(least))
    out = np.zeros((len(x.cls), len(y.cls)), bool)
    alive = np.ones((1, 1), bool)
    for k in range(max(len(x.sizes), len(y.sizes))):
        px, py = (z.parents[k] for z in (x, y))
        if not k:
            px, py = np.zeros(x.sizes[0], int), np.zeros(y.sizes[0], int)
        rows, cols = (np.flatnonzero(alive.any(axis=1 - s)[p]) for s, p in ((0, px), (1, py)))   # nodes with a live pair above
        if not len(rows) or not len(cols):
            return out
        live = alive[np.ix_(px[rows], py[cols])]
        cosine = x.units[rows] @ y.units[cols].T
        if k == len(x.sizes) - 1:
            out[np.ix_(rows, cols)] |= live & (cosine >= least)
            return out
        far, reach = _far(cosine), np.add.outer(x.radii[k][rows], y.radii[k][cols])
        live &= far <= bound + reach + _SLACK
        whole = live & (far + reach <= bound - _SLACK)
        if whole.any():
            full = np.zeros((x.sizes[k], y.sizes[k]), bool)
            full[np.ix_(rows, cols)] = whole
            out |= full[x.nodes(k)][:, y.nodes(k)]
            live &= ~whole
        alive = np.zeros((x.sizes[k], y.sizes[k]), bool)
        alive[np.ix_(rows, cols)] = live
    return out


def _reached(link: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest number that each row's and each column's component holds; every row is looked at once."""
    root_a, root_b = a.copy(), b.copy()
    new_a, new_b = link.any(axis=1), link.any(axis=0)
    for start in np.flatnonzero(new_a):
        if not new_a[start]:
            continue
        rows, in_a, in_b = np.array([start]), [], []
        new_a[start] = False
        while len(rows):
            in_a.append(rows)
            cols = np.flatnonzero(link[rows].any(axis=0) & new_b)
            new_b[cols] = False
            in_b.append(cols)
            rows = np.flatnonzero(link[:, cols].any(axis=1) & new_a)
            new_a[rows] = False
        in_a, in_b = np.concatenate(in_a), np.concatenate(in_b)
        root_a[in_a] = root_b[in_b] = min(a[in_a].min(), b[in_b].min())
    return root_a, root_b


def _counted(least: float):
    """``(cls, links, root)`` of every class with links in a pair of leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x, same = Block(row["x"]), row["a"] == row["b"]
                y = x if same else Block(row["y"])
                link = linked(x, y, least)
                if same:
                    np.fill_diagonal(link, False)
                    link |= link.T   # as rounding may differ
                roots = _reached(link, x.cls, y.cls)
                for z, m, other, root in [(x, link, y, roots[0])] + ([] if same else [(y, link.T, x, roots[1])]):
                    has = m.any(axis=1)
                    links = m[has].astype(np.float64) @ other.copies.astype(np.float64)   # exact below 2 ** 53
                    yield pa.RecordBatch.from_arrays([pa.array(z.cls[has]), pa.array(links.astype(np.int64)), pa.array(root[has])], ["cls", "links", "root"])
    return run


def _blocks(bound: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                b = _block(row["members"], bound)
                yield pa.RecordBatch.from_pydict({"node": [row["node"]]} | {k: pa.array([v], pa.binary()) for k, v in b.items()})
    return run


def near_vectors(vectors: DataFrame, least: float = 0.93, leaf: int = LEAF, fanout: int = FANOUT) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors(vec_id, embedding, label)``.

    * rows link if their labels are equal and their cosine, in double
      precision, is ``least`` or more (``least`` above -1).
    * a null label, and a vector that is null, empty, zero or holds a null or
      non-finite component, links with nothing; nor do vectors of different lengths.
    * n_links: other rows linked directly; repeated rows are rows of their own.
    * component_id: smallest vec_id reachable, the row's own included (null
      where all are null); kept: vec_id equals it.
    * an empty table gives an empty table; other columns are ignored."""
    bound = float(_far(np.float64(least)))
    kinds = vectors.select("vec_id", "label").schema
    rows = save(vectors.select("vec_id", "label", "embedding").mapInArrow(
        _units, f"vec_id {kinds['vec_id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, unit binary"))
    root = F.when(F.col("label").isNotNull() & F.col("unit").isNotNull(), F.concat_ws("/", F.col("label").cast("string"), F.octet_length("unit")))
    rows = rows.withColumn("node", root)
    classes = save(rows.where(F.col("node").isNotNull()).groupBy("node", "unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
                   .withColumn("cls", F.monotonically_increasing_id()))
    leaves, tree = _upper(classes.select("node", "cls", "copies", "unit"), leaf, fanout)
    members = leaves.groupBy("node").agg(F.collect_list(F.struct("cls", "copies", "unit")).alias("members"))   # at most ``leaf``
    blocks = save(members.mapInArrow(_blocks(bound), f"node string, {Block.FIELDS}"))
    pairs = _leaf_pairs(classes.select("node").distinct(), tree, bound)
    block = F.struct(*Block.KINDS)
    met = (pairs.join(blocks.select(F.col("node").alias("a"), block.alias("x")), "a")
           .join(blocks.select(F.col("node").alias("b"), block.alias("y")), "b")
           .select("a", "b", "x", F.when(F.col("a") != F.col("b"), F.col("y")).alias("y")))
    counted = save(met.mapInArrow(_counted(least), "cls long, links long, root long"))
    roots = components(counted.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = counted.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (classes.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
             .select("node", "unit", "first", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    ids = known.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = known.join(ids, "root").select("node", "unit", "n_links", "component_id", F.lit(True).alias("there"))
    out = rows.join(labels, ["node", "unit"], "left")
    component = F.when(F.col("there"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector: see ``near_vectors``."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT a AS vec_id, (SELECT count(*) FROM links l WHERE l.a = reach.a) AS n_links, min(b) AS component_id, min(b) = a AS kept FROM reach GROUP BY a
"""
