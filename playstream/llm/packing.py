"""Best-two-fit packing of tokenised documents into sequences.

1. Tasks tokenise whole documents and cut them into pieces (ids are not kept,
   their CRC is).
2. Only the histogram of piece lengths (as many rows as a sequence has
   tokens) reaches the driver, which packs lengths with their counts: fill a
   sequence greedily with the longest length that fits, then replace its
   smallest piece by two unpacked pieces that fill the expanded gap more
   tightly.  The same pattern is used as often as the counts allow, so the
   plan is small and equals packing piece by piece.
3. Pieces are numbered within their length, and their number selects the
   pattern, its copy and the place in it.
"""

from __future__ import annotations

import sys
import types
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstream.llm.common import WORKER, save, slices, table

LENGTH = 2048        # tokens of a sequence
END = 0              # id that ends a document
SALT_ROWS = 1 << 18  # pieces of one length that a task numbers
_STRINGS = 1 << 19   # distinct strings between blanks whose ids a task remembers
_WORDS = 1 << 19     # distinct words whose ids a worker process remembers
_JOINED = 1 << 14    # words that the tokeniser gets at once
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"   # ASCII marks but the apostrophe


def _classes() -> np.ndarray:
    """Classes by which the tokeniser's pattern cuts words, for the characters
    of ASCII and the Latin blocks: 1 letter, 2 number, 3 other, 0 white space
    (Unicode's, which the separators 0x1c to 0x1f are not)."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x250)]
    blank = {c for c in range(0x250) if chr(c).isspace()} - set(range(0x1c, 0x20))
    return np.array([0 if c in blank else {"L": 1, "N": 2}.get(k, 3) for c, k in enumerate(kinds)], np.int8)


class _Store:
    """Runs of ids by number, in arrays that grow by doubling."""

    def __init__(self) -> None:
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(sizes) > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.used:self.used + len(ids)] = ids
        self.sizes[self.n:self.n + len(sizes)] = sizes
        self.starts[self.n:self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.n += len(sizes)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' ids in a row, and the runs' sizes."""
        sizes = self.sizes[numbers]
        place = np.arange(int(sizes.sum())) + np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes)
        return self.ids[place], sizes


class _Numbers(dict):
    """Numbers of strings in order of their first look-up; ``new`` lists those without ids yet."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        self[key] = n = len(self)
        return n


class _Words:
    """Ids of words, encoded once by a worker process and remembered (up to a bound)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True
        self.classes = _classes()
        self.clear()

    def clear(self) -> None:
        self.numbers, self.store = _Numbers(), _Store()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def split(self, strings: list[str]) -> list[str]:
        """Each string without blanks as two words whose ids in a row are its
        own: the marks at its end go apart, in lower case.  A string whose
        characters are not ASCII or plain Latin letters, or that holds an
        apostrophe or a special token's mark, stays as it is."""
        out: list[str] = []
        add, classes = out.append, self.classes
        for string in strings:
            low = string.lower()
            if "'" in low or "<|" in low:
                add(string)
                add("")
            elif low.isascii() or (max(low + string) < "\u0250" and "\u0130" not in string and unicodedata.is_normalized("NFC", string)):
                word = low.rstrip(_MARKS)
                if word and classes[ord(word[-1])] == 3:   # one run with the marks
                    word = low
                add(word)
                add(low[len(word):])
            else:
                add(string)
                add("")
        return out

    def _plain(self, word: str) -> bool:
        return "'" not in word and "<|" not in word and (word.isascii() or (max(word) < "\u0250" and word == word.lower() and unicodedata.is_normalized("NFC", word)))

    def add_new(self) -> None:
        """Encode the words looked up since the last call, many as one text whose
        ids are cut after each one's last part.  Parts are counted by character
        class, so other words are encoded alone."""
        new, self.numbers.new = self.numbers.new, []
        for at in range(0, len(new), _JOINED):
            words = new[at:at + _JOINED]
            easy = [w for w in words if self._plain(w)]
            joined = "  ".join(easy) + " "
            kind = self.classes[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
            starts = (kind > 0) & ((kind == 2) | (kind != np.concatenate([[0], kind[:-1]])))
            upto = np.cumsum(starts)[np.cumsum(np.fromiter((len(w) + 2 for w in easy), np.int64, len(easy))) - 2] if easy else np.zeros(0, np.int64)
            ids = self.encode(joined)
            stops = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
            known = {}
            if easy and upto[-1] == len(stops) - 1 and stops[-1] == len(ids):
                if len(easy) == len(words):
                    self.store.add(ids, np.diff(stops[upto], prepend=0))
                    continue
                known = dict(zip(easy, zip(stops[np.concatenate([[0], upto[:-1]])].tolist(), stops[upto].tolist())))
            parts = [ids[slice(*known[w])] if w in known else self.encode(w) for w in words]
            self.store.add(np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts)))


class _Encoder:
    """Ids of texts, by way of the ids of the strings between their blanks: the
    tokeniser drops white space and merges only inside words, so a text's ids
    are its strings' ids in a row.  A string is put together from its words
    once and remembered (up to a bound)."""

    def __init__(self, path: str) -> None:
        self.words = _words(path)
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.store = _Numbers(), _Store()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbers) > _STRINGS:
            self._clear()
        if len(self.words.numbers) > _WORDS:
            self.words.clear()
        get = self.numbers.__getitem__
        found = []
        for t in texts:
            strings = _lower(t).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found.append(np.fromiter(map(get, strings), np.int64, len(strings)))
        new, self.numbers.new = self.numbers.new, []
        pairs = np.fromiter(map(self.words.numbers.__getitem__, self.words.split(new)), np.int64, 2 * len(new))
        self.words.add_new()
        ids, sizes = self.words.store.get(pairs)
        self.store.add(ids, sizes.reshape(-1, 2).sum(axis=1))
        return [self.store.get(x)[0] for x in found]


def _lower(text: str) -> str:
    """The text in lower case, where that is all the same to the tokeniser."""
    if "\u03a3" in text or "\u0130" in text or "<|" in text or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
        return text
    low = text.lower()
    return low if low.isascii() or unicodedata.is_normalized("NFC", low) else text   # T and a mark stay two, t and a mark become one


def _words(path: str) -> _Words:
    """This worker process's words; the process outlives a task."""
    own = sys.modules.setdefault(WORKER, types.ModuleType(WORKER)).__dict__
    if path not in own:
        own[path] = _Words(path)
    return own[path]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``; a null text is empty, so it is one piece of the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(tokenizer)
        for b in slices(batches, 128, remember=True):
            rows, nums, starts, sizes, crcs = [], [], [], [], []
            for row, ids in enumerate(encode([t or "" for t in b.column("text").to_pylist()])):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for num, at in enumerate(range(0, len(ids), length)):
                    part = ids[at:at + length]
                    for x, y in zip((rows, nums, starts, sizes, crcs), (row, num, at, len(part), zlib.crc32(part.tobytes()))):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(nums, pa.int32())]
                                             + [pa.array(x, pa.int64()) for x in (starts, sizes, crcs)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Best-two-fit over piece lengths: patterns (lengths in order) and how often each is used."""
    left = {n: c for n, c in counts.items() if c > 0}
    sizes = sorted(left)

    def longest(limit: int, used: Counter) -> int:
        """The longest length up to ``limit`` with an unused piece, else 0."""
        for k in range(bisect_right(sizes, limit) - 1, -1, -1):
            if left[sizes[k]] > used[sizes[k]]:
                return sizes[k]
        return 0

    patterns = []
    while sizes:
        used: Counter = Counter()
        gap = length
        while gap and (n := longest(gap, used)):
            used[n] += 1
            gap -= n
        while gap and len(used) + max(used.values()) > 2:
            small = min(used)
            used[small] -= 1
            best, pair = small, (small,)
            room = small + gap
            lo, hi = 0, bisect_right(sizes, room) - 1
            free = [left[n] - used[n] for n in sizes[:hi + 1]]
            while lo <= hi:  # two pointers over the free lengths
                a, b = sizes[lo], sizes[hi]
                if a + b > room or not free[hi]:
                    hi -= 1
                elif not free[lo] or (lo == hi and free[lo] < 2):
                    lo += 1
                else:
                    if a + b > best:
                        best, pair = a + b, (a, b)
                    lo += 1
            used.update(pair)
            used = +used
            if len(pair) == 1:
                break
            gap = room - best
        times = min(left[n] // k for n, k in used.items())
        patterns.append((tuple(sorted(used.elements(), reverse=True)), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        sizes = [n for n in sizes if n in left]
    return patterns


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Rows by (length, first number): numbers from ``first`` on take slots of the pattern, ``each`` in a copy."""
    rows, seen, base = [], Counter(), 0
    for pattern, times in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in pattern:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, places in offsets.items():  # equal lengths stand side by side
            rows.append((n, seen[n], base, len(places), places[0]))
            seen[n] += len(places) * times
        base += times
    rows.sort()
    return {k: np.array(v, np.int64) for k, v in zip(("length", "first", "base", "each", "offset"), zip(*rows))}


def pack(parts: DataFrame, length: int = LENGTH, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``parts`` of ``pieces`` with ``sequence_id`` and ``offset``.

    Every piece is placed once; places in a sequence are gapless from 0.  A
    length shared by very many pieces is numbered in salted groups, whose
    sizes are summed first.  An empty table gives an empty table; repeated
    documents are packed each."""
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``length`` rows
    if not counts:
        return parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = _places(plan(counts, length))
    many = parts.sparkSession.createDataFrame([(n, -(-c // salt_rows)) for n, c in counts.items()], "length long, salts long")
    salted = save(parts.join(F.broadcast(many), "length")  # at most ``length`` rows
                  .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts")).drop("salts"))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = salted.withColumn("number", number).join(before, ["length", "salt"]).withColumn("number", (F.col("number") + F.col("before")).cast("long")).drop("before", "salt")
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (places["length"] << 44) + places["first"]
        for b in batches:
            n, number = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(key, (n << 44) + number, "right") - 1
            rank, each = number - places["first"][at], places["each"][at]
            seq = places["base"][at] + rank // each
            offset = places["offset"][at] + (rank % each) * n
            yield pa.RecordBatch.from_arrays([b.column(c) for c in fields] + [pa.array(seq), pa.array(offset)], [*fields, "sequence_id", "offset"])

    kind = parts.schema["doc_id"].dataType.simpleString()
    return numbered.select(*fields, "number").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """Tokenise, cut and pack ``docs(doc_id, text)``; other columns are ignored."""
    return pack(save(pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), length)), length)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
