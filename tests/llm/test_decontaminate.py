import hashlib
import os
import re

from playstream.llm.common import recorded
from playstream.llm.decontaminate import contamination
from tests.llm.util import EDGE, SF0001, docs_of


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words_of(t)
        n = min(width, len(w))
        for at in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[at:at + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words_of(t), set(), set()
        for win, ids in windows.items():
            for at in range(len(w) - len(win) + 1):
                if tuple(w[at:at + len(win)]) == win:
                    hit |= set(range(at, at + len(win)))
                    found |= {str(i) for i in ids if i is not None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, gram int")


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "one, two"), (3, "solo"), (4, None), (5, ""),
         (6, "a b c d e f g h i j"), (6, "a b c d e f g h i k"), (None, "x1 y1 z1"), (7, "çödé ünï"), (8, "r r r r r r r r r r r r")]
DOCS = [(1, "zero one two three four five six seven eight nine TEN x"), (2, "two three four five six seven eight nine ten eleven"),
        (3, "Solo solo"), (4, "a b c d e f g h i j a b c d e f g h i k"), (5, "a-b c d e f g h i. J"), (6, "x1 y1 z1"), (7, "Çödé ünï"),
        (8, "r " * 30), (9, "one two three four five six seven eight nine"), (9, "one two three four five six seven eight nine"), (10, "one three two")]


def test_small_cases(spark):
    got = [tuple(r) for r in contamination(docs_of(spark, DOCS), items_of(spark, ITEMS)).collect()]
    assert sorted(got, key=str) == plain(DOCS, ITEMS)


def test_edge_rows(spark):
    for items in (ITEMS, [], [(1, None)]):
        got = [tuple(r) for r in contamination(docs_of(spark, EDGE), items_of(spark, items)).collect()]
        assert sorted(got, key=str) == plain(EDGE, items)
    assert contamination(docs_of(spark, []), items_of(spark, ITEMS)).collect() == []


def test_whole_table(spark):
    read = lambda name: spark.read.parquet(f"{SF0001}/{name}.parquet")
    got = [tuple(r) for r in contamination(read("documents"), read("benchmark")).collect()]
    rows = lambda name, key: [(r[key], r.text) for r in read(name).collect()]
    assert sorted(got, key=str) == plain(rows("documents", "doc_id"), rows("benchmark", "item_id"))
    assert any(r[-1] for r in got)


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def test_a_long_copied_passage_takes_room_in_proportion(spark):
    """100,000 words of a document stand in one item."""
    for n in (10000, 100000):
        passage = " ".join(f"w{i * 7919 % 99991} q{i}" for i in range(n // 2))
        paths = []
        with recorded(paths):
            got = contamination(docs_of(spark, [(1, f"before {passage} after"), (2, "clean words only")]), items_of(spark, [(5, passage)])).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == [(1, n + 2, n, 1), (2, 3, 0, 0)]
        assert sum(map(_size, paths)) < 300 * n   # bytes a word, whatever the length
