import random

from pyspark.sql import functions as F

from playstream.llm.lines import SHINGLE, _distances, band_keys, dedup_lines, form, op9_line_dedup, removals, shingles
from tests.llm.util import EDGE, SF0001, docs_of


def plain(rows):
    """Comparing all pairs of distinct lines."""
    first = {}
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            f = form(line)
            if f:
                first[f] = min(first.get(f, (1e18, 0)), (-1 if d is None else d, k))
    texts = list(first)
    up = {f: f for f in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = {f: shingles(f) for f in texts if len(f) >= SHINGLE}
    order = sorted(sets, key=lambda f: len(sets[f]))
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if 4 * len(sets[b]) > 5 * len(sets[a]):
                break
            shared = len(sets[a] & sets[b])
            if 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                up[top(a)] = top(b)
    keep = {}
    for f in texts:
        keep[top(f)] = min(keep.get(top(f), (1e18, 0)), first[f])
    out = []
    for d, t in rows:
        kept = None if t is None else "\n".join(
            line for k, line in enumerate(t.split("\n")) if not form(line) or keep[top(form(line))] == (-1 if d is None else d, k))
        out.append((d, kept))
    return sorted(out, key=str)


def near_rows(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            lines.append(rng.choice(["", " "]) + " ".join(w))
        rows.append((d, "\n".join(lines)))
    return rows


def test_small_corpora_equal_all_pairs(spark):
    rows = near_rows() + [(100, "Short"), (101, "Short\nshort\n\n\nShort "), (102, "é" * 40), (103, "é" * 41 + "\n" + "é" * 80)]
    got = [(r.doc_id, r.text) for r in dedup_lines(docs_of(spark, rows)).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = op9_line_dedup(spark, SF0001)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert got.columns == ["doc_id", "n_lines", "n_kept_lines", "text"]


def test_edge_rows(spark):
    docs = docs_of(spark, EDGE)
    got = dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == plain(EDGE)
    assert got.where(F.col("n_chars") != F.length("text")).count() == 0
    assert dedup_lines(docs_of(spark, [])).collect() == []


def test_band_recall():
    rng = random.Random(2)
    met = 0
    for _ in range(400):
        a = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)]
        b = a[:]
        while True:
            trial = b[:]
            trial[rng.randrange(300)] = "#"
            x, y = shingles("".join(a)), shingles("".join(trial))
            if 5 * len(x & y) < 4 * len(x | y):
                break
            b = trial
        k = band_keys(["".join(a), "".join(b)])
        met += bool((k[0] == k[1]).any())
    assert met >= 396


def test_chunks_of_one_bucket(spark):
    """Many variants of one line, in chunks far smaller than the bucket."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    base = [rng.choice(words) for _ in range(40)]
    rows = [(0, " ".join(base)), (1, " ".join(base))]
    for d in range(2, 70):
        w = base[:]
        for _ in range(rng.choice([1, 2, 3, 4, 5, 6])):
            w[rng.randrange(40)] = rng.choice(words[:30])
        rows.append((d, " ".join(w)))
    gone = {r.key.doc_id for r in removals(docs_of(spark, rows), chunk=7).collect()}
    assert {d for d, t in plain(rows) if not t} == gone


def test_distances_are_exact():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(SHINGLE, 60))) for _ in range(60)] + ["é" * 9, "é" * 30]
    xs, ys = zip(*[(rng.choice(texts), rng.choice(texts)) for _ in range(300)])
    for x, y, (apart, both) in zip(xs, ys, _distances(list(xs), list(ys))):
        a, b = shingles(x), shingles(y)
        assert (apart, both) == (len(a ^ b), len(a | b))


def test_copies_one_batch_apart(spark):
    """Copies of lines at the same row of two Arrow batches of one task."""
    rows = [(d, "\n".join([f"line {k}"] + [f"{c} passage of some length number {k}" for c in "abcdefg"])) for d, k in [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 1)]]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "8")
    try:
        got = [(r.doc_id, r.text) for r in dedup_lines(docs_of(spark, rows).coalesce(1)).collect()]
    finally:
        spark.conf.set(name, before)
    assert sorted(got, key=str) == plain(rows)
