import random
import re

from playstream.llm.licenses import COVER, PHRASES, TEMPLATES, common_words, least_votes, licenses, op5_license_scan
from tests.llm.util import EDGE, SF001, docs_of


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for p, label in PHRASES.items():
        p = p.split()
        mine = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += mine
        labels |= {label} if mine else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def check(got, texts):
    for r in got:
        assert tuple(r)[1:6] == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(","))))) and 0 <= r.score <= 1


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = op5_license_scan(spark, SF001).collect()
    assert len(got) == len(texts)
    check(got, texts)
    exact = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
             "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    for r in got:
        for notice, label in exact.items():
            assert (notice in texts[r.doc_id]) <= (label in r.labels.split(","))
        if not re.search("(?i)licen[sc]e|reserved", texts[r.doc_id]):
            assert r.labels == "" and r.score == 0


def test_edge_rows(spark):
    long_notice = TEMPLATES["gpl-3.0"][1]
    changed = long_notice.replace("redistribute it", "freely redistribute it again").replace("Foundation", "Found")
    rows = EDGE + [(40, "cc by CC-BY cc by"), (41, "pre " + changed + " post"), (42, "All rights reserved. all rights Reserved"),
                   (43, "Permission is hereby granted to nobody at all under the terms"), (44, (long_notice + " x ") * 50), (45, "Released under the MIT License. Released under the MIT License.")]
    got = licenses(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    check(got, dict(rows))
    by = {r.doc_id: r for r in got}
    assert "gpl-3.0" in by[41].labels and "gpl-3.0" in by[44].labels and by[45].labels == "mit"
    assert by[43].labels == ""
    assert licenses(docs_of(spark, [])).collect() == []


def test_spread_edits(spark):
    """Notices with changed words that are spread, of which at least 0.8 are left."""
    notices = [("gpl-3.0", TEMPLATES["gpl-3.0"][1], (5, 12, 19, 26), 31 / 35), ("bsd", TEMPLATES["bsd"][0], (5, 10, 15), 18 / 21),
               ("mit", TEMPLATES["mit"][1], (4, 9, 14), 17 / 20), ("mpl-2.0", TEMPLATES["mpl-2.0"][0], (4, 8, 12), 14 / 17),
               ("gpl-3.0", TEMPLATES["gpl-3.0"][1], (3, 7, 11, 15, 19, 23, 27), 28 / 35)]
    rows = []
    for n, (_, text, places, _) in enumerate(notices):
        words = re.findall("[A-Za-z0-9]+", text)
        rows.append((n, "before it " + " ".join(f"odd{i}" if i in places else w for i, w in enumerate(words)) + " and after it"))
    split = re.findall("[A-Za-z0-9]+", notices[0][1])   # inserted words far apart take votes, and the diagonal shifts
    rows.append((9, " ".join(w + " odd" * (i % 5 == 2) for i, w in enumerate(split))))
    got = {r.doc_id: r for r in licenses(docs_of(spark, rows)).collect()}
    for n, (label, _, _, share) in enumerate(notices):
        assert label in got[n].labels.split(",")
        assert got[n].score >= (1 if got[n].n_base else round(share, 3) - 0.001), (n, got[n].score)
    assert "gpl-3.0" in got[9].labels.split(",")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_words_are_exact():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert common_words(a, b) == lcs(a, b)


def test_votes_of_changed_copies():
    """However its changed words lie, a copy keeps the votes it needs."""
    rng = random.Random(4)
    for size in (3, 5, 8, 13, 21, 35, 60):
        changed = [size - -(-4 * size // 5)]
        for _ in range(50):
            places = set(rng.sample(range(size), changed[0]))
            votes = sum(not places & {i, i + 1, i + 2} for i in range(size - 2))
            assert votes >= least_votes(size) or votes == 0 and least_votes(size) == 1


def test_labels_and_scores_equal_a_plain_scan(spark):
    """Copies with changed, dropped and inserted words among other text: templates
    found at their best window, where enough of their shingles are left."""
    rng = random.Random(5)
    rows = [(n, _edited(rng)) for n in range(120)]
    got = {r.doc_id: r for r in licenses(docs_of(spark, rows)).collect()}
    found = 0
    for n, text in rows:
        words = re.findall("[a-z0-9]+", text.lower())
        shingles = {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
        sure, possible, best = set(), set(), 0.0
        for label, texts in TEMPLATES.items():
            for t in texts:
                t = re.findall("[a-z0-9]+", t.lower())
                share = lcs(words, t) / len(t)   # the texts hold one copy, so its best window is the text
                votes = sum(tuple(t[i:i + 3]) in shingles for i in range(len(t) - 2))
                if share >= COVER:
                    possible.add(label)
                    if votes >= least_votes(len(t)):
                        sure.add(label)
                        best = max(best, share)
        labels = set(filter(None, got[n].labels.split(","))) - set(PHRASES.values())
        assert sure <= labels <= possible, (n, text)
        assert got[n].score >= (1 if got[n].n_base else round(best, 9) - 1e-9)
        found += len(sure)
    assert found > 60


def _edited(rng):
    label = rng.choice(sorted(TEMPLATES))
    words = re.findall("[A-Za-z0-9]+", rng.choice(TEMPLATES[label]))
    out = []
    for w in words:
        kind = rng.random()
        out += [] if kind < 0.04 else [f"odd{rng.randint(0, 9)}"] if kind < 0.12 else [w, "put"] if kind < 0.15 else [w]
    other = lambda: " ".join(f"o{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30)))
    return f"{other()} {' '.join(out)} {other()}"
