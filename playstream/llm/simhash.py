"""Near-duplicate documents by SimHash and pivot distance tables.

1. Every text gets a 64-bit fingerprint: the majority, bit by bit, of the
   XXH64 hashes of its word shingles.  Equal fingerprints form one class.
2. Each class is measured once against a fixed set of reference fingerprints
   (the pivots); the Hamming distances are its row of the pivot table.
3. Classes meet where two of five blocks of their bits are equal: three
   differing bits leave at least two blocks alone, so no link is lost.
4. Of the classes that meet, a pair whose rows in the pivot table differ by
   more than the bound in any coordinate is discarded (triangle inequality);
   survivors are verified by their exact Hamming distance.
5. The links' spanning forests go to the distributed components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import as_bytes, fresh, row_key, rows_with, save, slices, table
from playstream.llm.components import components, forest

PIVOTS = 16          # reference fingerprints
CHUNK = 1024         # members of one bucket that a task compares with each other at once
_BITS_AT_ONCE = 1 << 15


def _pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: XXH64 of their own number, unsigned."""
    return [xxhash.xxh64_intdigest(str(i), seed=1) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """SimHash of UTF-8 ``text``: A-Z lower-cased, words between ASCII white
    space, shingles of ``words`` words (fewer: the whole sequence; none: 0)."""
    seq = text.lower().split()
    if not seq:
        return 0
    joined = b" ".join(seq)
    lengths = np.fromiter(map(len, seq), np.int64, len(seq))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    last = min(words, len(seq)) - 1
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(seq) - last
    for at in range(0, n, _BITS_AT_ONCE):
        to = min(n, at + _BITS_AT_ONCE)
        h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[at:to], ends[at + last:to + last])), np.uint64, to - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, h, fp)`` with fp as a signed long; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = [_signed(fingerprint(t, words)) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(fp, pa.int64())], ["doc_id", "h", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key()["h"].alias("h"), "text").mapInArrow(run, f"doc_id {kind}, h long, fp long")


def _links(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for x, y in zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist()):
                rows = x + (y or [])
                fp = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
                far = np.frombuffer(b"".join(r["far"] for r in rows), np.uint8).reshape(len(rows), -1).astype(np.int8)
                i, j = np.triu_indices(len(x), 1) if y is None else (
                    k.ravel() for k in np.meshgrid(np.arange(len(x)), np.arange(len(x), len(rows)), indexing="ij"))
                for p in range(far.shape[1]):  # the largest coordinate difference, one coordinate at a time
                    near = np.abs(far[i, p] - far[j, p]) <= bits
                    i, j = i[near], j[near]
                near = np.bitwise_count(fp[i] ^ fp[j]) <= bits
                for a, b in forest(len(rows), zip(i[near].tolist(), j[near].tolist())):
                    out_a.append(rows[a]["fp"])
                    out_b.append(rows[b]["fp"])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
    return run


def links(classes: DataFrame, bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Links ``(a, b)`` that span every component of the distinct fingerprints
    ``classes(fp)`` under "at most ``bits`` differing bits".

    A bucket of any size is dealt into chunks of about ``chunk`` members; each
    pair of chunks is one row, so no task gets a whole bucket."""
    blocks = bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in pair) for pair in combinations(range(blocks), 2)]
    far = F.concat(*[F.unhex(F.lpad(F.hex(F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p))))), 2, "0")) for p in _pivots()])
    keys = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    met = classes.select("fp", far.alias("far"), F.explode(keys).alias("k")).select("k.block", "k.key", "fp", "far")
    counts = met.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    lists = (met.join(counts, ["block", "key"]).withColumn("parts", F.ceil(F.col("n") / chunk))
             .withColumn("part", part).groupBy("block", "key", "parts", "part")
             .agg(F.collect_list(F.struct("fp", "far")).alias("xs")))
    lone = lists.where("parts = 1").select("xs", F.lit(None).cast(lists.schema["xs"].dataType).alias("ys"))
    many = lists.where("parts > 1")
    own = many.select("xs", F.lit(None).cast(lists.schema["xs"].dataType).alias("ys"))
    # each pair of chunks i < j: chunk i is sent to the pairs that it is the first of, chunk j to the others
    firsts = many.where("part < parts - 1").select("block", "key", "part", "xs", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("other"))
    seconds = many.where("part > 0").select("block", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)).alias("part"), F.col("part").alias("other"), F.col("xs").alias("ys"))
    across = firsts.join(seconds, ["block", "key", "part", "other"]).select("xs", "ys")
    return lone.unionByName(own).unionByName(across).mapInArrow(_links(bits), "a long, b long")


def _rooted(docs: DataFrame, words: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and ``(fp, first, n_links, root)`` of every class."""
    fps = save(fingerprints(docs, words))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    classes = save(fps.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n_links")))
    parts = components(links(classes.select("fp"), bits)).withColumnRenamed("node", "fp")
    return fps, classes.join(parts, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id, n_links)`` for every row of ``docs(doc_id, text)``.

    * component_id: smallest doc_id reachable over fingerprints at most
      ``bits`` bits apart, the row's own included; null where all ids are null.
    * null and empty texts have fingerprint 0 and link like any other;
      repeated rows stay; an empty table gives an empty table; other columns
      are ignored.
    * n_links: rows with the same fingerprint, itself included."""
    fps, rooted = _rooted(docs, words, bits)
    ids = rooted.groupBy("root").agg(F.min("first")["doc_id"].alias("component_id"))
    labels = rooted.join(ids, "root").select("fp", "component_id", "n_links")
    return fps.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def one_of_each(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each component - that of the smallest doc_id, a
    null one last - with all columns."""
    _, rooted = _rooted(docs, words, bits)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.h")
    key = fresh(docs, "key")
    return rows_with(docs, kept).withColumn(key, F.struct("doc_id", F.xxhash64("doc_id", "text"))).dropDuplicates([key]).drop(key)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
