import re

from playstream.llm.rules import counts, judged, op10_quality_rules
from tests.llm.util import EDGE, SF001, docs_of

MORE = [(20, "a b c a b c a b c"), (21, "x x x x x"), (22, "a b\x0bc\x0c d\re"), (23, "# a|b <c> $%&*\nq\nq\n\n\n q"), (24, "a b c d a b c"), (25, "\x00 b"), (26, "a b c d")]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    inside = {k for i, w in enumerate(windows) if w in twice for k in (i, i + 1, i + 2)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_query_counts_and_verdicts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    got = {r.doc_id: r for r in op10_quality_rules(spark, SF001).collect()}
    assert set(got) == set(texts)
    for d, r in got.items():
        p = plain(texts[d])
        assert tuple(r)[1:6] == p
        assert r.base_failed == (p[0] < 50 or 100 * p[4] > 50 * p[0])
        assert not (r.base_failed and r.kept)
    passed = [(r.kept, quality[d]) for d, r in got.items() if d in quality and not r.base_failed]
    good = [k for k, q in passed if q == 1]
    bad = [k for k, q in passed if q == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1


def test_edge_rows(spark):
    docs = docs_of(spark, EDGE + MORE)
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 0), (6, None), (6, 5)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        got = judged(docs, given).collect()
        assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(((d, *plain(t)) for d, t in EDGE + MORE), key=str)
    assert judged(docs_of(spark, []), labels).collect() == []
    assert counts(docs_of(spark, [(1, LONG)])).first().n_repeat_words == plain(LONG)[4]


LONG = "p q r s t " * 4000
