import random

import xxhash
from pyspark.sql import functions as F

from playstream.llm.simhash import fingerprint, fingerprints, links, near_duplicates, one_of_each, op2_simhash_near_dedup
from tests.llm.util import EDGE, SF0001, SF001, docs_of


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, bits=3):
    """Smallest id reachable, by comparing all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits and top(a) != top(b):
                up[top(a)] = top(b)
    first = {}
    for d, f in rows:
        if d is not None:
            first[top(f)] = min(d, first.get(top(f), d))
    return sorted(((d, f"{f:016x}", first.get(top(f))) for d, f in rows), key=str)


def test_query_equals_all_pairs(spark):
    got = [tuple(r)[:3] for r in op2_simhash_near_dedup(spark, SF001).collect()]
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(got, key=str) == plain_components(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_hash_is_sparks(spark):
    row = spark.createDataFrame([("a b c",)], "s string").select(F.xxhash64("s")).first()[0]
    assert row % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)
    assert fingerprint(b"A b\x0bC", 3) == row % 2**64


def test_edge_rows(spark):
    got = [tuple(r)[:3] for r in near_duplicates(docs_of(spark, EDGE)).collect()]
    assert sorted(got, key=str) == plain_components([(d, plain_fingerprint(t)) for d, t in EDGE])


def test_empty_table(spark):
    assert near_duplicates(docs_of(spark, [])).collect() == []


def test_buckets_over_many_chunks(spark):
    rng = random.Random(3)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 150:
        x = base
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(20)  # the upper blocks stay equal: one large bucket
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    found = links(df, chunk=16).collect()
    up = {x: x for x in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in found:
        a, b = r.a % 2**64, r.b % 2**64
        assert (a ^ b).bit_count() <= 3
        up[max(top(a), top(b))] = min(top(a), top(b))
    mine = {(x, top(x)) for x in fps}
    all_pairs = plain_components([(x, x) for x in fps])
    assert {(d, c) for d, _, c in all_pairs} == mine


def test_helper_columns_do_not_clash(spark):
    rows = [(1, "a b c d", "x", "y"), (2, "a b c d", "x", "y"), (3, "quite other words here", None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, key_ string")
    got = one_of_each(docs)
    assert got.columns == docs.columns and sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]
