"""Fill-in-middle against slicing in Python, and back."""

import hashlib

import numpy as np
import pytest

from playstream.llm import middle
from tests.llm.util import EDGE, docs_of


def plainly(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def random_texts(seed, count):
    rng = np.random.default_rng(seed)
    letters = np.array(list("ab <>PSM\n") + ["é", "ß", "€", "漢", "́", "😀", "\U0010ffff", "\x00", "\x7f", "\x80", "߿", "ࠀ"])
    return ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("block", [1, 40, 1 << 23])
def test_equals_slicing_and_goes_back(spark, monkeypatch, block):
    monkeypatch.setattr(middle, "BLOCK_BYTES", block)
    rows = EDGE + [(100 + i, t) for i, t in enumerate(random_texts(3, 400))] + [(7, "a<P>b"), (8, "<" * 9), (9, "x<M>")]
    docs = docs_of(spark, rows)
    out = middle.fill_in_middle(docs)
    got = out.select("*", middle.restored(out.output, out.form).alias("back")).collect()
    want = [plainly(*r) for r in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[5], r[2])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    texts = sorted((r[0] or 0, r[1] or "") for r in rows)
    assert sorted((r.doc_id or 0, r.back) for r in got) == texts


def test_units_by_number_and_byte():
    for text in random_texts(5, 300):
        data = text.encode()
        units = middle.Units(np.frombuffer(data, np.uint8))
        ends = np.cumsum([len(c.encode()) for c in text]).astype(np.int64)
        assert units.rank(np.array([len(data)]))[0] == len(text)
        assert (units.select(np.arange(1, len(text) + 1)) == ends).all()
        at = np.arange(len(data) + 1)
        assert (units.rank(at) == np.searchsorted(ends, at, "right")).all()


def test_forms_occur_at_their_rates(spark):
    docs = docs_of(spark, [(i, "some words") for i in range(4000)])
    n = {r.form: r["count"] for r in middle.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(n["plain"] - 400) < 100 and abs(n["spm"] - 720) < 120


def test_empty_table(spark):
    assert middle.fill_in_middle(docs_of(spark, [])).collect() == []
