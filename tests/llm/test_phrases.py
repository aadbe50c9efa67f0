"""Phrase collocations against counting in Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from playstream.llm import phrases
from pyspark.sql import types as T
from tests.llm.util import EDGE, LONG

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: with extra columns of names that the operator uses itself
ROWS = T.StructType([T.StructField(k, T.StringType()) for k in ("text", "lang", "phrase", "seg", "known")])


def docs_of(spark, rows):
    return spark.createDataFrame([(t, lang, "x", None, "y") for lang, t in rows], ROWS)


def plainly(rows, longest, least, cover, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang or "und"][tuple(w[i:i + size])] += 1
    out = []
    for lang, c in f.items():
        c = {p: a for p, a in c.items() if a >= least}
        covered = Counter()
        for p, a in c.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        covered[p[i:j]] = max(covered[p[i:j]], a)
        found = []
        for p, a in c.items():
            if len(p) > 1 and not 100 * covered[p] >= cover * a:
                s, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def random_rows(seed, count):
    rng = np.random.default_rng(seed)
    words = np.array(["a", "b", "c", "the", "The", "é", "x" * 9, "x" * 8 + "y", "\x00", "漢字", "of", "a-b"])
    gaps = np.array([" ", " ", " ", " ", "  ", "\t", ". ", "\n", " ,", "!"])
    langs = ["en", "fr", None, "und", "ε"]
    return [(langs[rng.integers(len(langs))], "".join(a + b for a, b in zip(rng.choice(words, k), rng.choice(gaps, k))))
            for k in rng.integers(0, 40, count)]


def check(spark, rows, longest, least, cover, top, **more):
    got = phrases.collocations(docs_of(spark, rows), longest, least, cover, top, **more).collect()
    assert sorted(tuple(r) for r in got) == plainly(rows, longest, least, cover, top)


@pytest.mark.parametrize("longest,least,cover,top,segment", [(4, 3, 80, 2000, None), (4, 2, 50, 7, 60), (2, 4, 80, 100, 300), (6, 2, 80, 2000, 25)])
def test_equals_counting(spark, longest, least, cover, top, segment):
    check(spark, random_rows(longest, 250), longest, least, cover, top, segment=segment)


def test_edge_rows_and_a_long_text(spark):
    rows = [("en", t) for _, t in EDGE] + [("de", "one two three " * 40), (None, "a b " * 50), ("de", "nolinebreak " * 3000 + "w" * 3000 + " end")]
    check(spark, rows, 4, 30, 80, 2000)
    check(spark, rows, 4, 30, 80, 2000, segment=1000)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    words = phrases.Words("en", b"aa b aa cc b aa b", 17)
    monkeypatch.setattr(phrases, "_mixed", lambda x: x & np.uint64(3))
    ids = words.exact()
    assert len(set(ids.tolist())) == 3 and ids[0] == ids[2] == ids[5] and ids[1] == ids[4] == ids[6]
    weak = next(phrases._materialised(3)(iter([pa.RecordBatch.from_pylist(
        [{"seg": 1, "lang": "en", "text": b"aa b aa cc b aa b", "own": 17, "known": [np.arange(4, dtype="<u8").tobytes()]}])])))
    got = {(r["phrase"], r["f"]) for r in weak.to_pylist()}
    assert got >= {("aa", 3), ("b", 3), ("cc", 1), ("aa b", 2), ("b aa", 2), ("aa cc", 1), ("cc b", 1), ("b aa b", 1), ("cc b aa", 1)} and len(got) == 12


def test_segments_of_a_task_share_rows(spark, monkeypatch):
    """The counting step makes rows by task, bucket and language, not by segment and phrase; counts stay exact where fingerprints collide."""
    monkeypatch.setattr(phrases, "_mixed", lambda x: (x & np.uint64(3)) << np.uint64(62))
    rows = [{"seg": i, "lang": "en" if i % 3 else "fr", "text": b"aa b aa cc b\naa " + b"d%d e" % (i % 7), "own": 20,
             "known": [(np.arange(4, dtype="<u8") << np.uint64(62)).tobytes()]} for i in range(90)]
    want = Counter()
    for r in rows:
        for piece in r["text"].decode().split("\n"):
            w = piece.split(" ")
            want.update((r["lang"], " ".join(w[i:i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    for most, limit in ((None, 8), (5000, 8 * 90)):
        packed = pa.Table.from_batches(list(phrases._packed(2, 3, most)(iter([pa.RecordBatch.from_pylist(rows)]))))
        assert packed.num_rows <= limit
        got = []
        for key in {(r["bucket"], r["lang"]) for r in packed.to_pylist()}:
            mine = packed.filter(pa.array([(r["bucket"], r["lang"]) == key for r in packed.to_pylist()]))
            got += [tuple(r.values()) for r in phrases._added(30)(mine).to_pylist()]
        assert sorted(got) == sorted((lang, p, p.count(" ") + 1, c) for (lang, p), c in want.items() if c >= 30)


def test_segments_keep_every_word_once(spark):
    rows = [("en", LONG), ("en", "a b. c " * 100), ("fr", "x" * 500)]
    segs = phrases.segments(docs_of(spark, rows), 4, 200).collect()
    assert sum(s.words for s in segs) == sum(len(re.findall(r"[^\s.]+", t)) for _, t in rows)
    assert max(s.own for s in segs if s.lang == "en") <= 200 and len({s.seg for s in segs}) == len(segs)


def test_empty_table(spark):
    assert phrases.collocations(docs_of(spark, [])).collect() == []
