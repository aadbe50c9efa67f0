"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of consecutive words of a benchmark item (ten, or the whole
item if it has fewer); a document is contaminated where a window occurs.

1. Windows are sets of word shingles with positions.  A bitmap of the shingles'
   hashes, sized by their number, goes to all tasks, and documents keep the word
   segments whose consecutive shingles all hit it (no segment that could hold
   a window is lost; false hits only cost work).
2. The segments' shingles are counted over the whole corpus; every window's
   shingles are ordered by rarity.  As all of them must occur, a prefix of one
   - the rarest - is enough, and only that one is joined.
3. Positions bound the window's place in the segment, lengths bound its end.
4. Survivors meet their document's words again, and are verified word by word
   over the item-sized window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import as_bytes, portions, row_key, rows_with, save, slices, table

WINDOW = 10          # words of a window
SHINGLE = 3          # words of a shingle; items of fewer words are one shingle
SLOT_BITS = range(22, 31)   # a bitmap has 2 ** 22 to 2 ** 30 bits, about this many for a shingle:
_SPARSE = 32

#: Bytes of a word, A-Z as a-z; all others separate words.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def word_list(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_FOLD).split()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash for each ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ c[i:i + n]) * np.uint64(_MIX[i])
        h ^= h >> np.uint64(29)
    return h


def _windows(items: DataFrame, width: int) -> DataFrame:
    """``(item_id, k, words, hashes)``: the windows of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[list] = [[], [], [], []]
            for item, text in zip(b.column("item_id").to_pylist(), as_bytes(b.column("text"))):
                words = word_list(text)
                size = min(width, len(words))
                for at in range(len(words) - size + 1 if words else 0):
                    part = words[at:at + size]
                    k = min(SHINGLE, size)
                    for x, y in zip(out, (item, k, [w.decode() for w in part], shingle_hashes(part, k).view(np.int64).tolist())):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([
                pa.array(out[0], b.schema.field("item_id").type), pa.array(out[1], pa.int32()),
                pa.array(out[2], pa.list_(pa.string())), pa.array(out[3], pa.list_(pa.int64()))], ["item_id", "k", "words", "hashes"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, k int, words array<string>, hashes array<long>")


class _Bitmap:
    """Which shingles may be of a window: for each shingle length in use (three
    at most) a bitmap by the hash's upper bits, 128 MB each at most."""

    def __init__(self, windows: DataFrame) -> None:
        shingles = windows.agg(F.sum(F.size("hashes"))).first()[0] or 0   # those of neighbouring windows repeat
        self.bits = min(max(SLOT_BITS[0], (_SPARSE * shingles // WINDOW).bit_length()), SLOT_BITS[-1])
        shift, size = np.uint64(64 - self.bits), 1 << (self.bits - 3)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            maps: dict[int, np.ndarray] = {}
            for b in batches:
                for k, hashes in zip(b.column("k").to_pylist(), b.column("hashes").to_pylist()):
                    at = np.array(hashes, np.int64).view(np.uint64) >> shift
                    np.bitwise_or.at(maps.setdefault(k, np.zeros(size, np.uint8)), (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([x.tobytes() for x in maps.values()], pa.binary())], ["k", "bits"])

        merged: dict[int, np.ndarray] = {}
        for row in windows.select("k", "hashes").coalesce(4).mapInArrow(run, "k int, bits binary").toLocalIterator():
            merged[row.k] = merged.get(row.k, 0) | np.frombuffer(row.bits, np.uint8)
        self.lengths = sorted(merged)
        self._sent = windows.sparkSession.sparkContext.broadcast({k: zlib.compress(x.tobytes(), 1) for k, x in merged.items()})
        self._maps: dict[int, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_maps": {}}

    def holds(self, k: int, hashes: np.ndarray) -> np.ndarray:
        if k not in self._maps:
            self._maps[k] = np.frombuffer(zlib.decompress(self._sent.value[k]), np.uint8)
        at = hashes >> np.uint64(64 - self.bits)
        return (self._maps[k][(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _segments(docs: DataFrame, bitmap: _Bitmap, least: dict[int, int]) -> DataFrame:
    """One row per document: ``doc_id, h, n_words`` and its segments (start,
    words, hashes by shingle length) of at least ``least[k]`` shingles in a row."""
    kind = pa.list_(pa.struct([("k", pa.int32()), ("start", pa.int64()), ("words", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            counts, found = [], []
            for text in as_bytes(b.column("text")):
                words, mine = word_list(text), []
                for k in bitmap.lengths:
                    h = shingle_hashes(words, k)
                    hit = np.concatenate([[False], bitmap.holds(k, h), [False]])
                    turn = np.flatnonzero(hit[1:] != hit[:-1])
                    for s, e in zip(turn[::2].tolist(), turn[1::2].tolist()):
                        if e - s >= least[k]:
                            mine.append({"k": k, "start": s, "words": [w.decode() for w in words[s:e + k - 1]], "hashes": h[s:e].view(np.int64).tolist()})
                counts.append(len(words))
                found.append(mine)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(counts, pa.int64()), pa.array(found, kind)], ["doc_id", "h", "n_words", "segments"])

    rows = docs.select("doc_id", row_key()["h"].alias("h"), "text")
    ids = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {ids}, h long, n_words long, segments array<struct<k:int,start:long,words:array<string>,hashes:array<long>>>")


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans [start, stop)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["stop"] - F.greatest(s["start"], a["stop"]), F.lit(0))).alias("n"),
        F.greatest(a["stop"], s["stop"]).alias("stop")), lambda a: a["n"])


def _found(docs: DataFrame, items: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' word counts, the windows, and the verified hits ``(doc_id, h, start, stop, window)``."""
    windows = save(_windows(items, width))
    least = {r.k: r.n for r in windows.groupBy("k").agg(F.min(F.size("hashes")).alias("n")).collect()}  # three rows at most
    segments = save(_segments(docs, _Bitmap(windows), least))
    of = F.struct("doc_id", "h").alias("of")   # rows alike in both are one text
    texts = segments.where(F.size("segments") > 0).select(of, "segments").dropDuplicates(["of"])
    parts = texts.select("of", F.posexplode("segments").alias("segment", "s"))
    grams = save(parts.select("of", "segment", "s.k", F.size("s.words").alias("size"), F.posexplode("s.hashes").alias("at", "gram")))
    rarity = grams.groupBy("k", "gram").agg(F.count("*").alias("df"))
    distinct = windows.select("k", "words", "hashes").distinct()
    tokens = distinct.select("k", "words", F.posexplode("hashes").alias("offset", "gram"))
    prefix = (tokens.join(rarity, ["k", "gram"], "left")  # a shingle that occurs nowhere is the rarest
              .groupBy("k", "words").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "gram")).alias("p"))
              .where("p.df > 0").select("k", "p.gram", "p.offset", F.col("words").alias("window")))
    first = F.col("at") - F.col("offset")
    near = save(grams.join(prefix, ["k", "gram"]).where((first >= 0) & (first + F.size("window") <= F.col("size")))
                .select("of", "segment", first.alias("first"), "window"))
    segment = F.get("segments", F.col("segment"))
    hits = save(near.join(texts, "of").where(F.slice(segment["words"], F.col("first") + 1, F.size("window")) == F.col("window"))
                .select("of.doc_id", "of.h", (segment["start"] + F.col("first")).alias("start"), "window")
                .select("doc_id", "h", "start", (F.col("start") + F.size("window")).alias("stop"), "window"))
    return segments.select("doc_id", "h", "n_words"), windows, hits


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns kept."""
    return rows_with(docs, _found(docs, items, width)[2], "left_anti")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per row of ``docs``.

    * null and empty texts have no words and are clean; so is every document
      of an empty benchmark; items without a word have no window.
    * items that share an id count once; an item with a null id hits words but
      is not listed; repeated documents get equal rows.
    * extra columns of either table are ignored."""
    counted, windows, hits = _found(docs, items, width)
    spans = (hits.groupBy(F.struct("doc_id", "h").alias("key"))
             .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")).select("key", _covered(F.col("spans")).alias("hit")))
    names = (hits.select("doc_id", "h", "window").distinct()
             .join(windows.select("item_id", F.col("words").alias("window")).distinct(), "window")
             .groupBy(F.struct("doc_id", "h").alias("key")).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    found = spans.join(names, "key").select(F.col("key").alias("found"), "hit", "items")
    rows = counted.select("doc_id", "n_words", F.struct("doc_id", "h").alias("key"))
    none = F.array().cast("array<string>")
    return (rows.join(found, rows["key"] == found["found"], "left")
            .select("doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
                    (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated")))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
       FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)),
hit AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN items USING (doc_id)
"""
