"""Phrase collocations by Rabin-Karp fingerprints.

1. Tasks bring texts into one form (pieces of words with single blanks) and
   write them as segments of bounded size, one language each.
2. Over a segment's bytes, prefix polynomials modulo 2 ** 64 give the
   fingerprint of any run of words as one difference: first all words and
   pairs, later all longer runs whose pairs are frequent.  A segment's sorted
   fingerprints and counts go to buckets of the fingerprint.
3. A bucket adds up the counts and points back to every segment that holds a
   frequent fingerprint (a colliding fingerprint only counts too much).
4. The segments look those up in their text: occurrences are verified word by
   word, words byte by byte, and frequent phrases only are materialised.  A
   task adds up its segments' phrases by their text and passes them on as one
   row a bucket and language, where all tasks' counts are added up exactly.
5. Spark's joins and aggregates score, thin out and rank the phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstream.llm.common import as_bytes, erase, save, slices, table

SEGMENT = 1 << 22        # bytes of a segment's own words; only a longer word alone exceeds it
BUCKET_TEXT = 1 << 25    # bytes of text whose fingerprints share a bucket, about
PHRASE_BYTES = 1 << 25   # bytes of materialised phrases that a task adds up before it passes them on
RANK_SALTS = 64          # parts that a language's phrases are ranked in first

#: Fixed classes: letters to lower case, blanks, ends of pieces.
_FORM = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_BREAKS = re.compile(rb" *\n[ \n]*")
_BLANKS = re.compile(rb"  +")

_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.dtype("<u8")


def _formed(text: bytes) -> bytes:
    """Words in lower case, one blank between the words of a piece, one line per piece."""
    return _BLANKS.sub(b" ", _BREAKS.sub(b"\n", text.translate(_FORM))).strip(b" \n")


def _cut(text: bytes, size: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """``text`` in parts of at most ``size`` own bytes with the number of those:
    cut between pieces if possible, else between words, where up to
    ``overlap`` words of the same piece follow as context."""
    at = 0
    while len(text) - at > size:
        line = text.rfind(b"\n", at, at + size + 1)
        if line > at:
            yield text[at:line], line - at
            at = line + 1
            continue
        blank = text.rfind(b" ", at, at + size + 1)
        if blank <= at:   # a word longer than a segment
            ends = [e for e in (text.find(b" ", at), text.find(b"\n", at)) if e >= 0]
            if not ends:
                break
            blank = min(ends)
        if text[blank:blank + 1] == b" ":
            end = blank
            for _ in range(overlap):
                m = re.compile(rb"[ \n]").search(text, end + 1)
                end = m.start() if m else len(text)
                if not m or text[end:end + 1] == b"\n":
                    break
            yield text[at:end], blank - at
        else:
            yield text[at:blank], blank - at
        at = blank + 1
    yield text[at:], len(text) - at


def segments(docs: DataFrame, longest: int, size: int | None = None) -> DataFrame:
    """``(seg, lang, text, own, words)`` of ``docs(lang, text)``: formed text, how
    many bytes of it and how many words are its own (the rest is context)."""
    size = size or SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(lang: str, text: bytes, own: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            words = 1 + text.count(b" ", 0, own) + text.count(b"\n", 0, own)
            return pa.RecordBatch.from_pydict({"seg": pa.array([number], pa.int64()), "lang": [lang], "text": pa.array([text], pa.binary()),
                                               "own": pa.array([own], pa.int64()), "words": pa.array([words], pa.int64())})

        def flush(lang: str) -> pa.RecordBatch:
            sizes.pop(lang)
            text = b"\n".join(waiting.pop(lang))
            return row(lang, text, len(text))

        for b in slices(batches):
            for lang, text in zip(b.column("lang").to_pylist(), as_bytes(b.column("text"))):
                text = _formed(text)
                if not text:
                    continue
                if len(text) > size:
                    for part, own in _cut(text, size, longest - 1):
                        yield row(lang, part, own)
                    continue
                if sizes.get(lang, 0) + len(text) > size:
                    yield flush(lang)
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                if sum(sizes.values()) > 4 * size:   # many languages
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield flush(lang)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text"))
    return rows.mapInArrow(run, "seg long, lang string, text binary, own long, words long")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _WORD)
    out[:1] = 1
    return np.cumprod(out, out=out)


class Words:
    """A segment's words, and the fingerprints of runs of them."""

    def __init__(self, lang: str, text: bytes, own: int) -> None:
        self.data = np.frombuffer(text, np.uint8)
        breaks = np.flatnonzero((self.data == 32) | (self.data == 10))
        self.starts = np.concatenate([[0], breaks + 1])
        self.ends = np.concatenate([breaks, [len(text)]])
        self.piece = np.concatenate([[0], np.cumsum(self.data[breaks] == 10)])
        self.own = int(np.searchsorted(self.starts, own))   # words that runs may start at
        self.sums = np.zeros(len(text) + 1, _WORD)   # the prefix polynomials
        np.cumsum((self.data.astype(_WORD) + np.uint64(1)) * _powers(_BASE, len(text)), out=self.sums[1:])
        self.down = _powers(_INVERSE, len(text) + 1)[self.starts]
        seed = 0
        for byte in lang.encode():
            seed = (seed * _BASE + byte + 1) % (1 << 64)
        self.seed = np.uint64(seed)

    def runs(self, n: int, context: bool = False) -> np.ndarray:
        """Numbers of the own (or: all) words at which runs of ``n`` words start."""
        first = np.arange(min(len(self.starts) if context else self.own, max(0, len(self.starts) - n + 1)))
        return first[self.piece[first] == self.piece[first + n - 1]]

    def prints(self, first: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the runs of ``n`` words from ``first`` on."""
        value = (self.sums[self.ends[first + n - 1]] - self.sums[self.starts[first]]) * self.down[first]
        return _mixed(value + self.seed)

    def spanned(self, known: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(n, first)`` of runs of three words and more all of whose pairs are among ``known``."""
        pairs = np.zeros(len(self.starts) + longest, bool)
        first = self.runs(2, context=True)
        pairs[first[_among(self.prints(first, 2), known)]] = True
        for n in range(3, longest + 1):
            runs = self.runs(n)
            yield n, runs[np.logical_and.reduce([pairs[runs + k] for k in range(n - 1)])]

    def exact(self) -> np.ndarray:
        """A number for every word, equal for equal bytes only: words are told
        apart by fingerprint, then compared with the first of theirs eight bytes at a time."""
        first = np.arange(len(self.starts))
        found, at, number = np.unique(self.prints(first, 1), return_index=True, return_inverse=True)
        size, rep = self.ends - self.starts, at[number]
        wrong = size != size[rep]
        eight = np.zeros(len(self.data) + 16, np.uint8)
        eight[:len(self.data)] = self.data
        eight = np.lib.stride_tricks.sliding_window_view(eight, 8)   # the eight bytes from every place on, not copied
        left = np.flatnonzero(~wrong & (rep != first))
        for off in range(0, int(size.max(initial=0)), 8):
            left = left[size[left] > off]
            rest = np.minimum(size[left] - off, 8).astype(np.uint64)
            differ = np.ascontiguousarray(eight[self.starts[left] + off]).view(_WORD).ravel() ^ np.ascontiguousarray(eight[self.starts[rep[left]] + off]).view(_WORD).ravel()
            bad = (differ << (np.uint64(64) - (rest << np.uint64(3)))) != 0
            wrong[left[bad]] = True
            left = left[~bad]
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(wrong).tolist():
            number[i] = others.setdefault(self.data[self.starts[i]:self.ends[i]].tobytes(), len(found) + len(others))
        return number

    def texts(self, first: np.ndarray, n: int) -> pa.BinaryArray:
        a, b = self.starts[first], self.ends[first + n - 1]
        at = np.cumsum(b - a) - (b - a)
        return _binaries(self.data[np.repeat(a - at, b - a) + np.arange(int((b - a).sum()))], b - a)


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Values of these sizes that follow each other in ``data``."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _known(row: dict) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(row["known"] or []), _WORD))


def _counted(bits: int, longest: int, first_round: bool):
    """A segment's fingerprints by bucket, with their counts where not one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            row = b.to_pylist()[0]
            words = Words(row["lang"], row["text"], row["own"])
            runs = [(n, words.runs(n)) for n in (1, 2)] if first_round else [*words.spanned(_known(row), longest)]
            prints = np.concatenate([words.prints(first, n) for n, first in runs])
            own = len(prints)
            if first_round:   # pairs in the context count in another segment, but are looked up here too
                pairs = words.runs(2, context=True)
                prints = np.concatenate([prints, words.prints(pairs[pairs >= words.own], 2)])
            prints, number = np.unique(prints, return_inverse=True)
            counts = np.bincount(number[:own], minlength=len(prints))
            cut = np.searchsorted(prints >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=_WORD))
            out: dict[str, list] = {"bucket": [], "once": [], "more": [], "counts": []}
            for k in np.flatnonzero(cut[1:] > cut[:-1]):
                p, c = prints[cut[k]:cut[k + 1]], counts[cut[k]:cut[k + 1]]
                for name, x in zip(out, (k, p[c == 1].tobytes(), p[c != 1].tobytes(), c[c != 1].astype("<u8").tobytes())):
                    out[name].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), pa.array([row["seg"]] * len(out["bucket"]), pa.int64())]
                                             + [pa.array(out[k], pa.binary()) for k in ("once", "more", "counts")],
                                             ["bucket", "seg", "once", "more", "counts"])
    return run


def _frequent(least: int):
    """Of a bucket's fingerprints, those that all segments together hold often enough, by segment."""
    def run(group: pa.Table) -> pa.Table:
        once, more = ([np.frombuffer(x, _WORD) for x in group.column(k).to_pylist()] for k in ("once", "more"))
        prints = np.concatenate(once + more)
        order = np.argsort(prints, kind="stable")
        prints = prints[order]
        counts = np.concatenate([np.ones(sum(map(len, once)), np.int64)] + [np.frombuffer(x, "<u8").astype(np.int64) for x in group.column("counts").to_pylist()])[order]
        start = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        often = prints[start][np.add.reduceat(counts, start) >= least]
        seg, known = [], []
        for s, a, b in zip(group.column("seg").to_pylist(), once, more):
            mine = np.concatenate([a, b])
            mine = mine[_among(mine, often)]
            if len(mine):
                seg.append(s)
                known.append(mine.tobytes())
        return pa.table({"seg": pa.array(seg, pa.int64()), "known": pa.array(known, pa.binary())})
    return run


def _materialised(longest: int):
    """``(lang, phrase, size, f, print)``: a segment's phrases with a frequent fingerprint, counted by their exact words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            row = b.to_pylist()[0]
            words, known = Words(row["lang"], row["text"], row["own"]), _known(row)
            ids = words.exact()
            found = []
            for n, first in [*((n, words.runs(n)) for n in (1, 2)), *words.spanned(known, longest)]:
                prints = words.prints(first, n)
                often = _among(prints, known)
                prints, first = prints[often], first[often]
                _, at, number = np.unique(prints, return_index=True, return_inverse=True)
                same = np.logical_and.reduce([ids[first + k] == ids[first[at][number] + k] for k in range(n)])
                total = np.bincount(number[same], minlength=len(at))
                others: dict[tuple, list[int]] = {}   # runs whose fingerprint is another's
                for i in first[~same].tolist():
                    others.setdefault(tuple(ids[i:i + n].tolist()), [i, 0])[1] += 1
                firsts = np.concatenate([first[at], np.array([i for i, _ in others.values()], np.int64)])
                counts = np.concatenate([total, np.array([c for _, c in others.values()], np.int64)])
                found.append((words.texts(firsts, n), np.full(len(firsts), n, np.int32), counts, words.prints(firsts, n)))
            phrases, *numbers = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * sum(map(len, phrases)), pa.string()), pa.concat_arrays(phrases).cast(pa.string())]
                                             + [pa.array(np.concatenate(x)) for x in numbers], ["lang", "phrase", "size", "f", "print"])
    return run


def _packed(bits: int, longest: int, most: int | None = None):
    """``(bucket, lang, phrases, counts)``: the phrases of a task's segments (one a
    line, none holds a line end) with their counts there, by bucket of the fingerprint."""
    most = most or PHRASE_BYTES

    def pack(lang: str, tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables).group_by(["print", "phrase"], use_threads=False).aggregate([("f", "sum")]).sort_by("print").combine_chunks()
        cut = np.searchsorted(t.column("print").to_numpy() >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=_WORD))
        used = np.flatnonzero(cut[1:] > cut[:-1])
        phrases, counts = t.column("phrase").to_pylist(), t.column("f_sum").to_numpy().astype("<i8")
        parts = [slice(cut[k], cut[k + 1]) for k in used]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([lang] * len(used), pa.string()), pa.array([b"\n".join(phrases[x]) for x in parts], pa.binary()),
                                           pa.array([counts[x].tobytes() for x in parts], pa.binary())], ["bucket", "lang", "phrases", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Table]] = {}
        size = 0
        for b in _materialised(longest)(batches):
            if not b.num_rows:
                continue
            t = pa.table({"print": b.column("print"), "phrase": b.column("phrase").cast(pa.binary()), "f": b.column("f")})
            waiting.setdefault(b.column("lang")[0].as_py(), []).append(t)
            size += t.nbytes
            if size > most:
                while waiting:
                    yield pack(*waiting.popitem())
                size = 0
        while waiting:
            yield pack(*waiting.popitem())
    return run


def _added(least: int):
    """``(lang, phrase, size, f)``: a bucket's phrases of one language that all tasks together hold often enough."""
    def run(group: pa.Table) -> pa.Table:
        data = np.frombuffer(b"\n".join(group.column("phrases").to_pylist()), np.uint8)
        ends = np.append(np.flatnonzero(data == 10), len(data))
        counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<i8")
        phrase = _binaries(data[data != 10], np.diff(ends, prepend=-1) - 1)
        t = pa.table({"phrase": phrase, "f": counts}).group_by("phrase", use_threads=False).aggregate([("f", "sum")])
        t = t.filter(pc.greater_equal(t.column("f_sum"), least))
        text = t.column("phrase").cast(pa.string())
        size = pc.add(pc.count_substring(text, " "), 1).cast(pa.int32())
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(t), pa.string()), "phrase": text, "size": size, "f": t.column("f_sum")})
    return run


def _with(segs: DataFrame, known: DataFrame) -> DataFrame:
    lists = known.groupBy("seg").agg(F.collect_list("known").alias("known"))   # of one segment, bounded like its text
    return segs.join(lists, "seg", "left").select("seg", "lang", "text", "own", "known")


def frequent_phrases(docs: DataFrame, longest: int = 4, least: int = 30, segment: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of 1 to ``longest`` words that
    occur ``least`` times or more in a language, and ``(lang, n)``: its words."""
    segs = save(segments(docs, longest, segment), "zstd")
    text = segs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(5, (text // BUCKET_TEXT).bit_length()))
    kinds = "bucket int, seg long, once binary, more binary, counts binary"
    found = []
    for first_round in (True, False):
        given = segs if first_round else _with(segs, found[0])
        prints = given.mapInArrow(_counted(bits, longest, first_round), kinds)
        found.append(save(prints.groupBy("bucket").applyInArrow(_frequent(least), "seg long, known binary")))
        if longest < 3:
            break
    known = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    rows = _with(segs, known).mapInArrow(_packed(bits + 2, longest), "bucket int, lang string, phrases binary, counts binary")
    phrases = save(rows.groupBy("bucket", "lang").applyInArrow(_added(least), "lang string, phrase string, size int, f long"))
    words = save(segs.groupBy("lang").agg(F.sum("words").alias("n")))   # a row per language
    erase(segs, *found)
    return phrases, words


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, cover: int = 80, top: int | None = 2000,
                 segment: int | None = None) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of ``docs(lang, text)``.

    * phrases of 2 to ``longest`` words that occur ``least`` times or more in
      their language (null: ``und``), over whole texts; A-Z are lowered;
      phrases never cross one of ``. , ; : ! ?`` or a line end.
    * score: floor(2000000 a / (l + r)) at the cut where it is lowest (ties:
      the shortest first part), l and r the counts of its two parts.
    * a phrase goes if a longer one (gone or not) that holds its words has
      at least ``cover`` in a hundred of its count.
    * the first ``top`` of a language (None: all) by score, count, then phrase in byte order.
    * null and empty texts have no phrases; repeated rows count each; an empty
      table gives an empty table; other columns are ignored."""
    f, words = frequent_phrases(docs, longest, least, segment)
    part = F.split("phrase", " ")
    wide = lambda c: F.col(c).cast("decimal(38,0)")  # noqa: E731  products may pass 64 bits
    many = f.where("size > 1").withColumn("part", part)
    ways = (many.select("lang", "phrase", "part", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("part", F.lit(1), F.col("k")), " ").alias("head"),
                    F.array_join(F.slice("part", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail")))
    heads = f.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = f.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = (ways.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
              .withColumn("s", F.expr("(cast(a as decimal(28,0)) * 2000000) div (cast(l as decimal(28,0)) + r)"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("s", "k", "l", "r", "a")).alias("best"))
              .select("lang", "phrase", "best.a", "best.l", "best.r", F.col("best.s").alias("score")))
    inner = (many.where("size > 2").select("lang", "part", "size", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("len"))
             .select("lang", "part", "f", "len", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("len") + 1)).alias("at"))
             .select("lang", F.array_join(F.slice("part", F.col("at"), F.col("len")), " ").alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * cover)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:   # no task gets all phrases of a language
        salt = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))
        kept = kept.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per phrase among the first 2000 of its language: see ``collocations``."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), words AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), f AS (
  SELECT lang, phrase, size, count(*) AS f FROM (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size)))
  GROUP BY lang, phrase, size HAVING count(*) >= 30
), many AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS p FROM f WHERE size > 1
), ways AS (
  SELECT m.lang, m.phrase, a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS s
  FROM (SELECT *, unnest(range(1, size)) AS k FROM many) m
  JOIN f l ON l.lang = m.lang AND l.phrase = array_to_string(p[1:k], ' ')
  JOIN f r ON r.lang = m.lang AND r.phrase = array_to_string(p[k + 1:], ' ')
), best AS (
  SELECT * FROM ways QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY s, k) = 1
), inside AS (
  SELECT lang, array_to_string(p[i:i + z - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - z + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS z FROM many)) GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY s DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, s AS score
FROM best b JOIN words USING (lang) LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""
