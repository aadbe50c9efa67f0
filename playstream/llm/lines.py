"""Fuzzy line dedup: MinHash banding, exact Jaccard verification and
distributed components, keeping one line of each component.

1. Tasks hash every line and take MinHash band keys of its character
   shingles; equal lines become one line before any two are compared.
2. Lines meet in the buckets of equal band keys.  Every member is compared
   with its bucket's commonest line: one pair a member, however large the
   bucket.  The Jaccard similarity of the whole shingle sets is exact.
3. Lines that share a commonest line but are still in different components are
   compared with each other inside tasks, in chunks of a bounded size, by
   products of 0/1 matrices over their shingles.  Chunks whose distances to the
   commonest line differ by more than a link allows (triangle inequality) don't
   meet.  Tasks give the links of spanning forests, never all pairs, so no link
   inside a bucket is lost.
4. Every component keeps the line that stands first by (doc_id, line number).

Bitmaps of fixed size tell the tasks which lines and keys occur twice or are
still of use; what they let through is joined exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.bitmap import Flags, shared
from playstream.llm.common import erase, fresh, release, row_key, save, slices, table
from playstream.llm.components import components, forest

SHINGLE = 7          # characters of a shingle; shorter lines match exact copies only
ROWS, BANDS = 4, 12  # a pair of similarity 0.8 meets with probability 0.998
NEAR = (4, 5)        # least Jaccard similarity, as a fraction
CHUNK = 256          # lines that a task compares with each other at once
_CHARS_AT_ONCE = 1 << 17
_COLUMNS_AT_ONCE = 1 << 12

_KEYS = [f"b{i}" for i in range(BANDS)]


def form(line: str) -> str:
    """What of a line is compared: all but the white space around it; blank lines have none and always stay."""
    return line.strip()


def line_id(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def shingles(text: str, size: int = SHINGLE) -> set[str]:
    return {text[i:i + size] for i in range(max(1, len(text) - size + 1))}


def _numbers(n: int) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(str(i)) for i in range(n)], np.uint32)


def _shingle_hashes(texts: list[str], kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts of at least one, and how many each has."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = len(chars) - SHINGLE + 1
    h = np.zeros(n, kind)
    factor, shift = (0x9E3779B97F4A7C15, 32) if kind is np.uint64 else (0x9E3779B1, 15)
    for i in range(SHINGLE):
        h ^= chars[i:i + n]
        h *= kind(factor)
        h ^= h >> kind(shift)
    inside = np.ones(n, bool)  # not the shingles that begin in one line and end in the next
    for at in (np.cumsum(sizes)[:-1, None] - np.arange(1, SHINGLE)).T:
        inside[at] = False
    return h[inside], sizes - SHINGLE + 1


def band_keys(texts: list[str]) -> np.ndarray:
    """(lines, bands) keys of texts of at least one shingle."""
    h, counts = _shingle_hashes(texts, np.uint32)
    starts = np.cumsum(counts) - counts
    keys = np.empty((len(texts), BANDS), np.uint64)
    numbers = _numbers(2 * ROWS * BANDS).reshape(-1, 2)
    for band in range(BANDS):
        key = np.full(len(texts), band + 1, np.uint64)
        for flip, factor in numbers[band * ROWS:(band + 1) * ROWS]:
            v = h ^ flip
            v *= factor | np.uint32(1)
            key = (key ^ np.minimum.reduceat(v, starts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[:, band] = key
    return keys.view(np.int64)


def _occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, h, line_no, line, b0..)`` of all lines that are not blank; a batch gives a line's keys once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 128):
            rows, numbers, ids = [], [], []
            texts: dict[str, int] = {}
            where: list[int] = []
            for row, text in enumerate(b.column("text").to_pylist()):
                for number, line in enumerate((text or "").split("\n")):
                    f = form(line)
                    if f:
                        rows.append(row)
                        numbers.append(number)
                        where.append(texts.setdefault(f, len(texts)))
            distinct = list(texts)
            ids = np.fromiter(map(line_id, distinct), np.int64, len(distinct))
            keys = np.zeros((len(distinct), BANDS), np.int64)
            long = [i for i, f in enumerate(distinct) if len(f) >= SHINGLE]
            at = 0
            while at < len(long):
                to, size = at, 0
                while to < len(long) and (to == at or size + len(distinct[long[to]]) <= _CHARS_AT_ONCE):
                    size += len(distinct[long[to]])
                    to += 1
                keys[long[at:to]] = band_keys([distinct[i] for i in long[at:to]])
                at = to
            where = np.array(where, np.int64)
            first = np.zeros(len(where), bool)
            first[np.unique(where, return_index=True)[1]] = True
            has = first & np.isin(where, np.array(long, np.int64))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("h").take(take), pa.array(numbers, pa.int64()), pa.array(ids[where])]
                + [pa.array(keys[where, k], mask=~has) for k in range(BANDS)], ["doc_id", "h", "line_no", "line", *_KEYS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{k} long" for k in _KEYS)
    return docs.select("doc_id", row_key()["h"].alias("h"), "text").mapInArrow(run, f"doc_id {kind}, h long, line_no long, line long, {columns}")


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("line").to_numpy().view(np.uint64)


def _every(batch: pa.RecordBatch) -> tuple[np.ndarray, None]:
    """The lines, each row an owner of its own."""
    return _ids(batch), None


def _values(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A batch's band keys, and the line of each."""
    keys = [batch.column(k).to_numpy().view(np.uint64) for k in _KEYS]
    return np.concatenate(keys), np.tile(batch.column("line").to_numpy(), BANDS)


def _with_lines(df: DataFrame, *bitmaps: Flags) -> DataFrame:
    """The rows whose line is in one of the bitmaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for m in bitmaps:
                keep |= m.holds(_ids(b))
            yield b.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)


def _without_lines(df: DataFrame, bitmap: Flags) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~bitmap.holds(_ids(b))))

    return df.mapInArrow(run, df.schema)


def _met(keyed: DataFrame, bitmap: Flags) -> DataFrame:
    """``(line, n, key)`` of the band keys that the bitmap of shared keys holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lines = _values(b)
            keep = bitmap.holds(keys)
            n = np.tile(b.column("n").to_numpy(), BANDS)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(lines[keep]), pa.array(n), pa.array(keys[keep].view(np.int64))], ["line", "n", "key"])

    return keyed.mapInArrow(run, "line long, n long, key long")


def _texts(docs: DataFrame, bitmap: Flags) -> DataFrame:
    """``(line, text)`` of the lines in the bitmap, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lines = list({form(x) for t in b.column("text").to_pylist() for x in (t or "").split("\n")} - {""})
            ids = np.fromiter(map(line_id, lines), np.int64, len(lines))
            keep = bitmap.holds(ids.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array([x for x, k in zip(lines, keep.tolist()) if k], pa.string())], ["line", "text"])

    return docs.select("text").mapInArrow(run, "line long, text string").dropDuplicates(["line"])


def _sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' distinct shingle hashes (52 bits) in a row, where each text's begin, and how many."""
    h, counts = _shingle_hashes(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    key = np.sort((h >> np.uint64(12)) | owner << np.uint64(52))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    sizes = np.bincount((key >> np.uint64(52)).astype(np.int64), minlength=len(texts))
    return key & np.uint64((1 << 52) - 1), np.cumsum(sizes) - sizes, sizes


def _near(shared: int, both: int) -> bool:
    return shared * NEAR[1] >= both * NEAR[0]


def _counted(x: str, y: str) -> tuple[int, int]:
    a, b = shingles(x), shingles(y)
    return len(a & b), len(a | b)


def _distances(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """For each pair of texts the shingles that one of them has, and those that
    either has.  Equal hashes of different shingles can only make texts look
    nearer; pairs that are near by less than a few shingles are counted again
    on the shingles themselves."""
    texts = list(dict.fromkeys(xs + ys))
    number = {t: i for i, t in enumerate(texts)}
    values, begins, sizes = _sets(texts)
    i, j = (np.fromiter((number[t] for t in side), np.int64, len(side)) for side in (xs, ys))
    n = np.concatenate([sizes[i], sizes[j]])
    at = np.arange(int(n.sum())) + np.repeat(np.concatenate([begins[i], begins[j]]) - (np.cumsum(n) - n), n)
    pair = np.repeat(np.tile(np.arange(len(xs), dtype=np.uint64), 2), n)
    key = np.sort(values[at] | pair << np.uint64(52))
    twice = key[1:][key[1:] == key[:-1]] >> np.uint64(52)
    shared = np.bincount(twice.astype(np.int64), minlength=len(xs))
    out = []
    for x, y, s, total in zip(xs, ys, shared.tolist(), (sizes[i] + sizes[j]).tolist()):
        both = total - s
        if _near(s, both) and not _near(s - 3, both + 3):
            s, both = _counted(x, y)
        out.append((both - s, both))
    return out


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, apart, both)`` of distinct pairs of line ids: the exact Jaccard
    distance as a fraction ``apart / both``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = _distances(b.column("x").to_pylist(), b.column("y").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")] + [pa.array([g[k] for g in got], pa.int64()) for k in range(2)], ["a", "b", "apart", "both"])

    of = lambda side, name: texts.select(F.col("line").alias(side), F.col("text").alias(name))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, apart long, both long")


def _links_between(rows: list[dict], first: int) -> list[tuple[int, int]]:
    """Near pairs of different components among ``rows(line, root, text)``: of
    the first ``first`` rows with the others, or of all if there are no others."""
    values, begins, sizes = _sets([r["text"] for r in rows])
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    use = counts[column] > 1
    owner, column = owner[use], column[use]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(rows), len(rows)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS_AT_ONCE):
        part = slice(*np.searchsorted(column, [at, at + _COLUMNS_AT_ONCE]))
        m = np.zeros((len(rows), _COLUMNS_AT_ONCE), np.float32)
        m[owner[part], column[part] - at] = 1
        shared += m @ m.T
    both = sizes[:, None] + sizes[None, :] - shared
    roots = np.unique([r["root"] for r in rows], return_inverse=True)[1]
    near = (shared * NEAR[1] >= both * NEAR[0]) & (roots[:, None] != roots[None, :])
    near = near[:first, first:] if first < len(rows) else np.triu(near, 1)
    out = []
    for i, j in np.argwhere(near).tolist():
        j += first if first < len(rows) else 0
        s, b = shared[i, j], both[i, j]
        if _near(s - 3, b + 3) or _near(*_counted(rows[i]["text"], rows[j]["text"])):
            out.append((i, j))
    return out


def _across(groups: DataFrame, chunk: int) -> DataFrame:
    """Links ``(a, b)`` between different components of ``groups(low, line, root, far, text)``.

    A group is dealt into chunks by distance and hash; pairs of chunks are rows."""
    step = 1 - NEAR[0] / NEAR[1]
    ring = F.floor(F.col("far") / F.lit(step + 1e-9)).cast("long")  # of lines two rings apart none are near
    dealt = groups.withColumn("ring", ring)
    counts = dealt.groupBy("low", "ring").agg(F.ceil(F.count("*") / chunk).alias("parts"))
    lists = (dealt.join(counts, ["low", "ring"]).withColumn("part", F.pmod(F.xxhash64("line"), "parts"))
             .groupBy("low", "ring", "part", "parts").agg(F.collect_list(F.struct("line", "root", "text")).alias("xs")))
    lists = save(lists)
    kind = lists.schema["xs"].dataType
    own = lists.where(F.size("xs") > 1).select("xs", F.lit(None).cast(kind).alias("ys"))
    # a chunk meets the later chunks of its ring and all of the next ring
    same = lists.where("part < parts - 1").select("low", F.col("ring").alias("r"), "xs", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)).alias("p"))
    nexts = counts.select("low", (F.col("ring") - 1).alias("ring"), F.col("parts").alias("others"))
    then = (lists.join(nexts, ["low", "ring"])
            .select("low", (F.col("ring") + 1).alias("r"), "xs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("p")))
    ys = lists.select("low", F.col("ring").alias("r"), F.col("part").alias("p"), F.col("xs").alias("ys"))
    pairs = same.unionByName(then).join(ys, ["low", "r", "p"]).select("xs", "ys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            a, b = [], []
            for xs, ys in zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist()):
                rows = xs + (ys or [])
                if len({r["root"] for r in rows}) > 1:
                    for i, j in forest(len(rows), _links_between(rows, len(xs))):
                        a.append(rows[i]["line"])
                        b.append(rows[j]["line"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return own.unionByName(pairs).mapInArrow(run, "a long, b long")


def removals(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(key, lines)``: of each document (doc_id and text hash) the numbers of the lines that go."""
    spark = docs.sparkSession
    occurrences = save(_occurrences(docs))
    places = occurrences.select("doc_id", "h", "line_no", "line")
    repeated = Flags(spark, shared(occurrences.select("line"), _every))
    sketches = occurrences.where(F.col(_KEYS[0]).isNotNull()).select("line", *_KEYS)
    known = save(_with_lines(sketches, repeated).groupBy("line").agg(F.count("*").alias("n"), *[F.first(k).alias(k) for k in _KEYS]))
    keyed = known.unionByName(_without_lines(sketches, repeated).withColumn("n", F.lit(1).cast("long")))
    keys = Flags(spark, shared(keyed, _values))
    met = save(_met(keyed, keys))
    keys.forget()
    common = F.min(F.struct((-F.col("n")).alias("n"), "line"))["line"]  # often the one that the others were made from
    buckets = met.groupBy("key").agg(common.alias("low"), F.count("*").alias("lines")).where("lines > 1").select("key", "low")
    members = save(met.join(buckets, "key").select("line", "low").distinct())
    erase(met, known)
    wanted = Flags(spark, shared(members.select("line"), _every, owners=1))  # every low is a member too
    texts = save(_texts(docs, wanted))
    wanted.forget()
    release(spark)
    tested = save(_compared(members.where("line <> low").select(F.col("line").alias("a"), F.col("low").alias("b")), texts))
    release(spark)
    links = tested.where(F.col("apart") * NEAR[1] <= F.col("both") * (NEAR[1] - NEAR[0])).select("a", "b")
    parts = components(links).withColumnRenamed("node", "line")
    apart = tested.select(F.col("a").alias("line"), F.col("b").alias("low"), (F.col("apart") / F.col("both")).alias("far"))
    release(spark)
    placed = save(apart.join(parts, "line", "left").select("low", "line", "far", F.coalesce("root", "line").alias("root")))
    several = placed.groupBy("low").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("low")
    more = save(_across(placed.join(several, "low", "left_semi").join(texts, "line"), chunk))
    release(spark)
    stars = parts.select(F.col("line").alias("a"), F.col("root").alias("b"))   # stand for the links found first
    parts = components(stars.unionByName(more)).withColumnRenamed("node", "line")
    linked = Flags(spark, shared(parts.select("line"), _every, owners=1))
    concerned = save(_with_lines(places, repeated, linked))
    repeated.forget()
    linked.forget()
    erase(occurrences, texts, tested, placed)
    firsts = concerned.groupBy("line").agg(F.min(F.struct("doc_id", "line_no", "h")).alias("first"), F.count("*").alias("n"))
    rooted = firsts.join(parts, "line", "left").where("n > 1 OR root IS NOT NULL").select("line", "first", "n", F.coalesce("root", "line").alias("root"))
    rooted = save(rooted)
    keepers = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    gone = concerned.join(rooted.join(keepers, "root").select("line", "keeper"), "line").where(F.struct("doc_id", "line_no", "h") != F.col("keeper"))
    out = save(gone.groupBy(F.struct("doc_id", "h").alias("key")).agg(F.sort_array(F.collect_set("line_no")).alias("lines")))
    erase(concerned, rooted)
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with the lines that go taken out of text
    (and n_chars, where there is one, counted again).

    * of equal or near lines (exact Jaccard similarity of 0.8 on character
      shingles, chains included) the first by doc_id, then by line number,
      stays; a null id comes first; rows alike in doc_id and text are one
      document and stay alike;
    * blank lines stay; a null text stays null, an empty one empty; a text may
      lose all its lines; an empty table gives an empty table."""
    of, lines = fresh(docs, "key"), fresh(docs, "lines")
    gone = removals(docs).select(F.col("key").alias(of), F.col("lines").alias(lines))
    key = F.struct(docs["doc_id"], F.xxhash64(docs["doc_id"], docs["text"]))
    joined = docs.join(gone, key == F.struct(gone[of]["doc_id"], gone[of]["h"]), "left")
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for text, lines in zip(b.column("text").to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                if lines:
                    drop = set(lines)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
                out.append(text)
            columns = [pa.array(out, b.schema.field("text").type) if n == "text" else b.column(i) for i, n in enumerate(names)]
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([None if t is None else len(t) for t in out], pa.int64()).cast(b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*[docs[c] for c in names], gone[lines]).mapInArrow(run, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_lines, n_kept_lines, text)`` of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    return dedup_lines(docs).select("doc_id", "n_lines", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_kept_lines"), "text")
