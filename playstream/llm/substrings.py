"""Exact removal of repeated byte strings by blockwise sorting of suffixes.

A suffix matters up to ``MIN`` bytes here, so it is a window of the text.

1. Cover sample: the positions whose 24-byte hash is the least among the
   windows around them.  Like a difference cover's sample it holds a place at
   the same offset in any two equal windows - here it is chosen by content,
   which takes a third of the positions that an arithmetic cover takes.  The
   sample's hash is its rank: equal strings, equal ranks.
2. Ranks met in two documents are found one bucket of ranks at a time; a
   bitmap, larger for larger inputs, tells the tasks which samples may be shared.
3. Neighbouring samples that may be shared form chunks, cut by content.  A
   chunk that also stands in a document of a smaller id is removed whole; its
   samples need no further look.  Only chunks that a second bitmap says two
   documents may have are compared.
4. Every window belongs to its least sample.  The windows of a sample form a
   context; one that also stands in a document of a smaller id goes whole.
5. Where one rank has several contexts, their windows are a suffix bucket.
   Tasks sort one bucket at a time and compare neighbours byte by byte; equal
   ranks already decide the sample's 24 bytes, the rest is sorted.  A bucket
   of very many contexts is grouped by Spark, window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.bitmap import Flags, shared, slots_for
from playstream.llm.common import as_bytes, erase, portions, release, row_key, save, slices, table

MIN = 50                   # bytes of a repeated string
SAMPLE = 24                # bytes of a cover sample, a multiple of eight
_SPAN = MIN - SAMPLE + 1   # samples in a window
_MARK = 15                 # a sample whose rank has these bits clear begins a chunk
SORTED_ROWS = 20000        # most contexts of one rank that a task sorts
BLOCK = 1 << 21            # bytes of text whose cover is found at once
_BATCH_ROWS = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _slide(f: Callable, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` over all windows of ``width`` neighbours, by doubling."""
    k = 1
    while 2 * k <= width:
        x = f(x[:-k], x[k:])
        k *= 2
    rest = width - k
    return f(x[:len(x) - rest], x[rest:]) if rest else x


def cover(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The texts' cover samples in order: number of the text, rank, first window and how many windows."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = b"".join(texts)
    n = len(data)
    none = np.zeros(0, np.int64)
    if not (sizes >= MIN).any():
        return none, none.astype(np.uint64), none, none
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,)).copy()
    rank = np.zeros(n - SAMPLE + 1, np.uint64)
    for at in range(0, SAMPLE, 8):
        rank = _mix(rank ^ words[at:at + len(rank)])
    order = np.maximum((rank >> np.uint64(32)).astype(np.uint32), np.uint32(1))
    least = _slide(np.minimum, order, _SPAN)
    edge = np.zeros(n + 1, np.int8)  # windows that end inside their text
    long = sizes >= MIN
    edge[begins[long]] += 1
    edge[ends[long] - MIN + 1] -= 1
    inside = np.cumsum(edge, dtype=np.int8)[:n - MIN + 1].view(bool)
    least[~inside] = 0
    pad = np.zeros(_SPAN - 1, np.uint32)
    sample = np.flatnonzero(_slide(np.maximum, np.concatenate([pad, least, pad]), _SPAN) == order)
    at = np.flatnonzero(inside)
    least = least[at]
    k = np.searchsorted(sample, at)
    wrong = np.flatnonzero(order[sample[k]] != least)
    while len(wrong):
        k[wrong] += 1
        wrong = wrong[order[sample[k[wrong]]] != least[wrong]]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    lo = at[first]
    number = np.flatnonzero(long)  # empty texts begin where others do
    text = number[np.searchsorted(begins[long], lo, "right") - 1]
    return text, rank[sample[k[first]]], lo - begins[text], np.diff(np.append(first, len(at)))


def covered(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``cover`` of the texts, some together and a longer one in blocks, each of
    whose windows belongs to one block: a block's end only cuts a sample's
    windows in two.  Memory is that of a block and of what is found."""
    found, group, size = [], [], 0

    def flush() -> None:
        if group:
            text, *rest = cover([texts[i] for i in group])
            found.append((np.array(group, np.int64)[text], *rest))
            group.clear()

    for i, t in enumerate(texts):
        if size + len(t) > BLOCK:
            flush()
            size = 0
        if len(t) <= BLOCK:
            group.append(i)
            size += len(t)
            continue
        for at in range(0, len(t) - MIN + 1, BLOCK):
            text, rank, lo, n = cover([t[at:at + BLOCK + MIN - 1]])
            found.append((text + i, rank, lo + at, n))
    flush()
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip((none, none.astype(np.uint64), none, none), *found))


def _spread(rank: np.ndarray) -> np.ndarray:
    """A rank's value for bitmaps: a sample is the least around it, so ranks
    themselves crowd into a fraction of a bitmap."""
    return _mix(rank.view(np.uint64))


def _ranks(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ranks of a batch's texts, spread, and the number (h) of the document each is from."""
    ranks, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for b in portions([batch]):
        text, rank, _, _ = covered(as_bytes(b.column("text")))
        ranks.append(_spread(rank))
        owners.append(b.column("h").to_numpy().view(np.uint64)[text])
    return np.concatenate(ranks), np.concatenate(owners)


def _contexts(docs: DataFrame, ranks: Flags) -> DataFrame:
    """One row per document: the contexts of its samples that may be shared,
    and the chunks they form (number of the first sample, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in portions(batches, rows=64):
            texts = as_bytes(b.column("text"))
            text, rank, lo, n = covered(texts)
            keep = ranks.holds(_spread(rank))
            text, rank, lo, n = text[keep], rank[keep], lo[keep], n[keep]
            end = lo + n
            begins = (rank & np.uint64(_MARK)) == 0
            begins[:1] = True
            begins[1:] |= (text[1:] != text[:-1]) | (lo[1:] != end[:-1])
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(lo))[:len(first)] - 1
            views = list(map(memoryview, texts))
            of = lambda t, a, z: np.fromiter((digest(views[i][x:y]) for i, x, y in zip(t.tolist(), a.tolist(), (z + MIN - 1).tolist())), np.uint64, len(t))
            cuts = np.searchsorted(text, np.arange(b.num_rows + 1))
            chunk_cuts = np.searchsorted(text[first], np.arange(b.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in (
                rank.view(np.int64), of(text, lo, end).view(np.int64), lo.astype(np.int32), n.astype(np.int32))]
            lists += [pa.ListArray.from_arrays(pa.array(chunk_cuts, pa.int32()), pa.array(x)) for x in (
                (first - cuts[text[first]]).astype(np.int32), of(text[first], lo[first], end[last]).view(np.int64))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), *lists], ["doc_id", "h", "rank", "context", "lo", "n", "chunk", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, h long, rank array<long>, context array<long>, lo array<int>, n array<int>, chunk array<int>, digest array<long>")


class _Samples:
    """A batch of ``_contexts`` as flat arrays: samples, chunks, and the row of each."""

    def __init__(self, b: pa.RecordBatch) -> None:
        flat = lambda name: b.column(name).flatten().to_numpy()
        size = lambda name: b.column(name).value_lengths().to_numpy()
        self.rank, self.context, self.lo, self.n = (flat(k) for k in ("rank", "context", "lo", "n"))
        self.row = np.repeat(np.arange(b.num_rows), size("rank"))
        self.h = b.column("h").to_numpy()
        starts = np.cumsum(size("rank")) - size("rank")
        self.chunk_row = np.repeat(np.arange(b.num_rows), size("chunk"))
        self.first = flat("chunk") + starts[self.chunk_row]
        self.digest = flat("digest")
        self.last = np.append(self.first[1:], len(self.rank))[:len(self.first)] - 1

    def owned(self) -> np.ndarray:
        """A value of each chunk in its document."""
        return _mix(self.digest.view(np.uint64) ^ _mix(self.h[self.chunk_row].view(np.uint64)))

    def alike(self) -> np.ndarray:
        """A value of each chunk in any document: of its first rank and digest."""
        return _mix(self.digest.view(np.uint64) ^ _mix(self.rank[self.first].view(np.uint64)))

    def open(self, met: Flags, chunks: Flags) -> np.ndarray:
        """Which samples are in chunks that no other document has, or that the bitmap of open chunks holds."""
        return np.repeat(~met.holds(self.alike()) | chunks.holds(self.owned()), self.last - self.first + 1)


def _alike(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The chunks, and the number (h) of the document each is from."""
    s = _Samples(batch)
    return s.alike(), s.h[s.chunk_row].view(np.uint64)


def _chunks(kept: DataFrame, met: Flags) -> DataFrame:
    """``(doc_id, h, rank, digest, start, stop, own)``: the chunks that two
    documents may have, told apart by their first rank and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = _Samples(b)
            left = met.holds(s.alike())
            rows, first, last = pa.array(s.chunk_row[left]), s.first[left], s.last[left]
            stop = s.lo[last] + s.n[last] + np.int32(MIN - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), b.column("h").take(rows), pa.array(s.rank[first]), pa.array(s.digest[left]), pa.array(s.lo[first]),
                 pa.array(stop), pa.array(s.owned()[left].view(np.int64))], ["doc_id", "h", "rank", "digest", "start", "stop", "own"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, h long, rank long, digest long, start int, stop int, own long")


def _own(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    own = batch.column("own").to_numpy().view(np.uint64)
    return own, own


def _document(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The documents' numbers, mixed."""
    h = _mix(batch.column("h").to_numpy().view(np.uint64))
    return h, h


def _open_ranks(met: Flags, chunks: Flags):
    """Ranks, spread, and documents of the samples in open chunks."""
    def values(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        s = _Samples(batch)
        left = s.open(met, chunks)
        return _spread(s.rank[left]), s.h[s.row[left]].view(np.uint64)
    return values


def _occurrences(kept: DataFrame, met: Flags, chunks: Flags, ranks: Flags) -> DataFrame:
    """``(doc_id, h, rank, context, lo, n)`` of the samples in open chunks whose rank another document's open chunk may have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = _Samples(b)
            left = s.open(met, chunks) & ranks.holds(_spread(s.rank))
            rows = pa.array(s.row[left])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), b.column("h").take(rows)] + [pa.array(x[left]) for x in (s.rank, s.context, s.lo, s.n)],
                                             ["doc_id", "h", "rank", "context", "lo", "n"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, h long, rank long, context long, lo int, n int")


def _read(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The first contexts' bytes: ``(rank, context, first, places, n, bytes)``."""
    wanted = save(firsts.groupBy(F.struct("first", F.col("places")[0]["h"].alias("h")).alias("at")).agg(
        F.collect_list(F.struct("rank", "context", "places", "n")).alias("all")))
    held = Flags(docs.sparkSession, shared(wanted.select("at.h"), _document, owners=1))

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            yield b.filter(pa.array(held.holds(_document(b)[0])))

    some = docs.select("doc_id", "h", "text").mapInArrow(only, docs.select("doc_id", "h", "text").schema)
    rows = some.select(F.struct("doc_id", "h").alias("key"), "text")
    found = rows.join(wanted, rows["key"] == wanted["at"]).dropDuplicates(["key"]).select("text", "key.doc_id", "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            items = b.column("all").to_pylist()
            texts = [t[x["places"][0]["lo"]:x["places"][0]["lo"] + x["n"] + MIN - 1] for t, mine in zip(as_bytes(b.column("text")), items) for x in mine]
            rows_ = pa.array(np.repeat(np.arange(b.num_rows), list(map(len, items))), pa.int64())
            flat = b.column("all").flatten()
            yield pa.RecordBatch.from_arrays([flat.field("rank"), flat.field("context"), b.column("doc_id").take(rows_), flat.field("places"), flat.field("n"), pa.array(texts, pa.binary())],
                                             ["rank", "context", "first", "places", "n", "bytes"])

    kinds = {f.name: f.dataType.simpleString() for f in firsts.schema}
    return found.mapInArrow(run, f"rank long, context long, first {kinds['first']}, places {kinds['places']}, n int, bytes binary")


def _repeated(first: np.ndarray, n: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and offset of the windows that also stand in a context of a smaller document."""
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    sizes = n + MIN - 1
    begins = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    at = begins[of] + offset
    words = np.ndarray((len(data) - 7,), ">u8", data.data, 0, (1,)).astype(np.uint64)
    keys = [words[at + i] for i in range(0, MIN - 7, 8)] + [words[at + MIN - 8]]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    who = first[of[order]]
    least = np.minimum.reduceat(who, np.flatnonzero(new)) if len(who) else who
    hit = order[least[np.cumsum(new) - 1] < who]
    hit.sort()
    return of[hit], offset[hit]


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of rank; whole buckets are sorted together, a few thousand rows at once."""
    def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        ids = t.column("first").to_pylist()
        code = {x: i for i, x in enumerate(sorted(set(ids)))}
        of, offset = _repeated(np.array([code[x] for x in ids]), t.column("n").to_numpy().astype(np.int64), t.column("bytes").to_pylist())
        # runs of neighbouring offsets
        start = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (offset[1:] != offset[:-1] + 1)])) if len(of) else of
        stop = np.append(start[1:], len(of))
        places = t.column("places").to_pylist()
        out: list[list] = [[], [], [], []]
        for s, e in zip(start.tolist(), stop.tolist()):
            for p in places[of[s]]:
                for x, y in zip(out, (ids[of[s]], p["h"], p["lo"] + int(offset[s]), p["lo"] + int(offset[e - 1]) + MIN)):
                    x.append(y)
        return pa.RecordBatch.from_arrays([pa.array(out[0], t.schema.field("first").type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], ["doc_id", "h", "start", "stop"])

    held: list[pa.RecordBatch] = []
    for b in slices(batches, _BATCH_ROWS):
        rank = b.column("rank").to_numpy()
        cut = int(np.searchsorted(rank == rank[-1], True))  # the last bucket may go on
        if cut == 0 and held and held[-1].column("rank")[-1].as_py() == rank[0]:
            held.append(b)
            continue
        if cut:
            held.append(b.slice(0, cut))
        if held and sum(x.num_rows for x in held) >= _BATCH_ROWS:
            yield done(held)
            held = []
        held.append(b.slice(cut))
    if held:
        yield done(held)


def repeats(docs: DataFrame, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """``(doc_id, h, start, stop)``: byte ranges of ``docs(doc_id, h, text)`` that go; they may overlap."""
    spark = docs.sparkSession
    slots = slots_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    ranks = Flags(spark, shared(docs.select("h", "text"), _ranks, slot_bits=slots))
    kept = save(_contexts(docs, ranks))
    ranks.forget()
    release(spark)
    met = Flags(spark, shared(kept, _alike))
    release(spark)
    chunks = _chunks(kept, met)
    low = chunks.groupBy("rank", "digest").agg(F.min("doc_id").alias("first"))
    chunks = save(chunks.join(low, ["rank", "digest"]).select("doc_id", "h", "start", "stop", "own", (F.col("first") < F.col("doc_id")).alias("gone")))
    release(spark)
    open_chunks = Flags(spark, shared(chunks.where("NOT gone").select("own"), _own, owners=1))
    whole = save(chunks.where("gone").select("doc_id", "h", "start", "stop"))
    open_ranks = Flags(spark, shared(kept, _open_ranks(met, open_chunks), slot_bits=slots))
    occurrences = save(_occurrences(kept, met, open_chunks, open_ranks))
    met.forget()
    open_chunks.forget()
    open_ranks.forget()
    erase(kept, chunks)
    firsts = save(occurrences.groupBy("rank", "context").agg(F.min("doc_id").alias("first")))
    release(spark)
    several = firsts.groupBy("rank").agg(F.count("*").alias("contexts")).where("contexts > 1")
    known = firsts.join(several, "rank", "left")
    placed = save(occurrences.join(known, ["rank", "context"]).where("first < doc_id OR contexts > 1"))
    erase(occurrences, firsts)
    certain = save(placed.where("first < doc_id").select("doc_id", "h", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + MIN - 1).alias("stop")))
    own = save(placed.where("first = doc_id").groupBy("rank", "context", "first", "n", "contexts")
               .agg(F.sort_array(F.collect_set(F.struct("h", "lo"))).alias("places")))  # places in one document
    erase(placed)
    small = save(_read(docs, own.where(F.col("contexts") <= sorted_rows).drop("contexts")))
    release(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = save(small.repartition("rank").sortWithinPartitions("rank").mapInArrow(_sorted_buckets, f"doc_id {kind}, h long, start int, stop int"))
    erase(small)
    large = save(_read(docs, own.where(F.col("contexts") > sorted_rows).drop("contexts")))
    erase(own)
    windows = large.select("first", "places", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"), "bytes").select(
        "first", "places", "at", F.substring("bytes", F.col("at") + 1, F.lit(MIN)).alias("window"))
    least = windows.groupBy("window").agg(F.min("first").alias("least"))
    hot = (windows.join(least, "window").where("least < first").select("first", "at", F.explode("places").alias("p"))
           .select(F.col("first").alias("doc_id"), "p.h", (F.col("p.lo") + F.col("at")).alias("start"), (F.col("p.lo") + F.col("at") + MIN).alias("stop")))
    return whole.unionByName(certain).unionByName(ranges).unionByName(hot)


def without_repeats(docs: DataFrame, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs(doc_id, text)``.

    * a byte goes if a string of ``MIN`` bytes around it also starts in a
      document of a smaller doc_id, judged on the input; texts shorter than
      that stay whole, null counts as empty;
    * rows of one doc_id don't repeat each other; a null id is neither smaller
      nor larger than any; other columns are ignored; an empty table gives an
      empty table."""
    rows = docs.select("doc_id", row_key()["h"].alias("h"), "text")
    found = repeats(rows.where("doc_id IS NOT NULL"), sorted_rows)
    ranges = found.groupBy(F.struct("doc_id", "h").alias("of")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    joined = rows.join(ranges, F.struct("doc_id", "h") == F.col("of"), "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 128):
            out: list[list] = [[], [], [], []]
            for text, mine in zip(as_bytes(b.column("text")), b.column("ranges").to_pylist()):
                digest, at, spans, gone, stop = hashlib.sha256(), 0, 0, 0, -1
                for r in mine or ():
                    if r["start"] > stop:
                        spans += 1
                        digest.update(text[at:r["start"]])
                        at = r["start"]
                    if r["stop"] > stop:
                        gone += r["stop"] - max(at, r["start"])
                        at = stop = r["stop"]
                digest.update(text[at:])
                for x, y in zip(out, (len(text), gone, spans, digest.hexdigest())):
                    x.append(y)
            yield pa.RecordBatch.from_arrays([b.column("doc_id")] + [pa.array(x, t) for x, t in zip(out, [pa.int64()] * 3 + [pa.string()])],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 100)) AS win FROM d, unnest(range(0, n - 49)) AS t(p)),
f AS (SELECT win, min(doc_id) AS first FROM w GROUP BY win),
hit AS (SELECT doc_id, p FROM w JOIN f USING (win) WHERE first < doc_id),
g AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS turn FROM hit),
r AS (SELECT doc_id, p, sum(turn) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM s),
c AS (SELECT k.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
             string_agg(substr(x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) || max(CASE WHEN next IS NULL THEN substr(x, 2 * z + 1) ELSE '' END) AS kept
      FROM k JOIN d USING (doc_id) GROUP BY k.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""
