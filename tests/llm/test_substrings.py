import hashlib
import random

import numpy as np
import pyarrow as pa

from playstream.llm import substrings
from playstream.llm.bitmap import Flags, shared, slots_for
from playstream.llm.common import portions, row_key, save
from playstream.llm.substrings import MIN, cover, op6_suffix_array_dedup, without_repeats
from tests.llm.util import EDGE, SF0001, docs_of


def plain(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - MIN + 1 if d is not None else 0):
            w = b[i:i + MIN]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - MIN + 1 if d is not None else 0):
            if first[b[i:i + MIN]] < d:
                gone[i:i + MIN] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((gone[:-1] < gone[1:]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mixed(seed, docs=60):
    """Texts of pieces that others hold too, cut and joined at random places."""
    rng = random.Random(seed)
    pick = lambda n, of="abcdefgh ": "".join(rng.choice(of) for _ in range(n))
    pieces = [pick(rng.randint(10, 160)) for _ in range(12)] + ["é" * 40, "ab" * 60, "x" * 130]
    rows = []
    for d in range(docs):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pieces)
            a = rng.randint(0, len(p))
            parts += [rng.choice([p, p[a:], p[:a]]), pick(rng.choice([0, 1, 30]))]
        rows.append((rng.choice([d, d, d + 1]), "".join(parts)))
    return rows


def test_cut_and_joined_pieces(spark):
    for seed in range(3):
        rows = mixed(seed)
        for limit in (20000, 1):
            got = [tuple(r) for r in without_repeats(docs_of(spark, rows), sorted_rows=limit).collect()]
            assert sorted(got, key=str) == plain(rows)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = [tuple(r) for r in op6_suffix_array_dedup(spark, SF0001).collect()]
    assert sorted(got, key=str) == plain(rows)
    assert sum(r[2] for r in got) > 1000


def test_edge_rows(spark):
    rows = EDGE + [(11, "é" * 24), (12, "é" * 25), (13, "é" * 25 + "x"), (14, "q" * 3000), (15, "q" * 60), (-3, "q" * 49), (None, "q" * 80)]
    got = [tuple(r) for r in without_repeats(docs_of(spark, rows)).collect()]
    assert sorted(got, key=str) == plain(rows)
    assert without_repeats(docs_of(spark, [])).collect() == []
    assert len(without_repeats(docs_of(spark, [(None, None), (1, "")])).collect()) == 2


def test_only_chunks_of_two_documents_are_compared(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(20000))
    rows = docs_of(spark, [(1, base), (2, "".join(c if i % 700 else "#" for i, c in enumerate(base)))])
    rows = rows.select("doc_id", row_key()["h"].alias("h"), "text")
    kept = save(substrings._contexts(rows, Flags(spark, shared(rows.select("h", "text"), substrings._ranks))))
    one, two = ({(r.rank[c], d) for c, d in zip(r.chunk, r.digest)} for r in kept.collect())
    met = Flags(spark, shared(kept, substrings._alike))
    got = {(r["rank"], r.digest) for r in substrings._chunks(kept, met).collect()}
    assert one & two == got and 0 < len(got) < len(one | two)


def test_ranks_spread_over_the_whole_bitmap(spark):
    """Samples are the least around them; their ranks as they are would fill a fraction of a bitmap."""
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, 3000).astype(np.uint8).tobytes().decode() for _ in range(40)]
    value, owner = substrings._ranks(pa.RecordBatch.from_pydict({"h": list(range(40)), "text": texts}))
    assert len(value) > 5000 and len(set(owner.tolist())) == 40
    share = np.bincount((value >> np.uint64(60)).astype(int), minlength=16) / len(value)
    assert share.min() > 0.04 and share.max() < 0.09

    rows = docs_of(spark, [(1, texts[0]), (2, texts[0][:1500] + texts[1]), (3, texts[2])])
    rows = rows.select("doc_id", row_key()["h"].alias("h"), "text")
    kept = save(substrings._contexts(rows, Flags(spark, shared(rows.select("h", "text"), substrings._ranks))))
    batch = kept.toArrow().to_batches()[0]
    none = Flags(spark, np.zeros(1 << 24, np.uint8))   # no chunk is shared: all are open
    value, _ = substrings._open_ranks(none, none)(batch)
    assert len(value) > 50 and 0.3 < (value >> np.uint64(63)).mean() < 0.7


def _held(batch):
    return batch.column("v").to_numpy().view(np.uint64), batch.column("o").to_numpy().view(np.uint64)


def test_a_larger_input_gets_a_larger_bitmap(spark):
    assert [slots_for(n) for n in (0, 10**6, 10**9, 2 * 10**9, 10**10, 10**12)] == [27, 27, 27, 28, 30, 30]
    rng = np.random.default_rng(8)
    v = rng.integers(-2**63, 2**63 - 1, 40000)
    rows = [(int(x), o) for i, x in enumerate(v) for o in ((1, 2) if i < 20000 else (1,))]
    df = spark.createDataFrame(rows, "v long, o long").coalesce(1)
    let = {}
    for bits in (16, 28):
        flags = Flags(spark, shared(df, _held, slot_bits=bits))
        held = flags.holds(v.view(np.uint64))
        assert held[:20000].all()
        let[bits] = held[20000:].mean()
    assert let[28] < 0.01 < 0.2 < let[16] < 0.35   # 20,000 of 65,536 slots


def test_cover_holds_every_window():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.choice([0, 49, 50, 51, 400]))) for _ in range(40)] + [b"", b"z" * 500]
    text, rank, lo, n = cover(texts)
    seen = {}
    for t, a, k in zip(text.tolist(), lo.tolist(), n.tolist()):
        for i in range(a, a + k):
            assert (t, i) not in seen
            seen[t, i] = True
    assert len(seen) == sum(max(0, len(t) - MIN + 1) for t in texts)
    # equal windows have equal ranks, wherever they stand
    by = {}
    for t, r, a, k in zip(text.tolist(), rank.tolist(), lo.tolist(), n.tolist()):
        for i in range(a, a + k):
            assert by.setdefault(texts[t][i:i + MIN], r) == r


def test_texts_in_blocks_have_the_same_windows(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (0, 49, 50, 51, 300, 2500, 20, 999)]
    monkeypatch.setattr(substrings, "BLOCK", 400)
    text, rank, lo, n = substrings.covered(texts)
    got = sorted((int(t), int(a) + k) for t, a, m in zip(text, lo, n) for k in range(m))
    assert got == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - substrings.MIN + 1)]   # every window once


def test_long_texts_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 500)
    rng = np.random.default_rng(4)
    base = rng.integers(97, 123, 6000).astype(np.uint8).tobytes().decode()
    rows = [(1, base[:3000]), (2, "x" + base[1000:5000]), (3, base[2700:3300] + "!" + base[100:700]), (4, base)]
    got = [tuple(r) for r in without_repeats(docs_of(spark, rows)).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_portions_are_bounded_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * k for k in (5, 5, 30, 0, 4, 4, 4)] + [None]})
    assert [[len(x or "") for x in b.column("text").to_pylist()] for b in portions(iter([batch]), most=10)] == [[5, 5], [30], [0, 4, 4], [4, 0]]
