"""Fill-in-middle: texts cut at two code points and put together in another order.

1. A document's numbers come from the SHA-256 of its id, by Spark's functions.
2. Tasks find the cuts over Arrow buffers of whole texts, without a loop over
   characters: the UTF-8 bytes are viewed as 64-bit words, bytes that end a
   code point are marked arithmetically in all eight lanes at once, the marks
   of every word are counted, a code point's number is searched in the running
   counts, and the place inside its word is found by lane-wise prefix sums.
3. Parts are cut out and joined by Spark's functions; so is the way back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import table

BLOCK_BYTES = 1 << 23   # bytes of text that are looked at together; a longer text alone

#: Fixed marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_HIGH = np.uint64(0x8080808080808080)   # the highest bit of each lane
_ONES = np.uint64(0x0101010101010101)


class Units:
    """The code points of UTF-8 ``data`` (uint8), by number and by byte."""

    def __init__(self, data: np.ndarray) -> None:
        words = np.zeros(len(data) // 8 + 2, "<u8")   # a word to spare, so that every byte has a next one
        words.view(np.uint8)[:len(data)] = data
        starts = ~(words & ~(words << np.uint64(1))) & _HIGH   # all but 10xxxxxx
        self.ends = starts >> np.uint64(8)
        self.ends[:-1] |= starts[1:] << np.uint64(56)
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.ends), dtype=np.int64, out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points end before byte ``at``."""
        word, lane = at >> 3, (at & 7).astype(np.uint64)
        low = (np.uint64(1) << (lane << np.uint64(3))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & low)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte after the ``number``-th code point, from 1."""
        word = np.searchsorted(self.before, number, "left") - 1
        nth = (number - self.before[word]).astype(np.uint64)
        upto = (self.ends[word] >> np.uint64(7)) * _ONES   # ends up to each lane, its own included
        reached = ((upto | _HIGH) - nth * _ONES) & _HIGH
        return 8 * word + 9 - np.bitwise_count(reached)


def _cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Of each text: code points, code points and bytes up to the smaller and the larger cut."""
    if text.null_count:
        text = text.fill_null(b"")
    wide = pa.types.is_large_binary(text.type)
    at = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
    out = [np.zeros(len(text), np.int64) for _ in range(5)]
    h1, h2 = (x.to_numpy(zero_copy_only=False) for x in (one, two))
    row = 0
    while row < len(text):
        to = max(row + 1, int(np.searchsorted(at, at[row] + BLOCK_BYTES, "right")) - 1)
        own = at[row:to + 1] - at[row]
        units = Units(data[at[row]:at[to]])
        ranks = units.rank(own)
        n = np.diff(ranks)
        cut = np.sort([h1[row:to] % (n + 1), h2[row:to] % (n + 1)], axis=0)
        ends = [np.where(c > 0, units.select(np.maximum(ranks[:-1] + c, 1)) - own[:-1], 0) for c in cut]
        for x, y in zip(out, (n, *cut, *ends)):
            x[row:to] = y
        row = to
    return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "first", "second", "first_byte", "second_byte"])


def numbers(doc_id: Column, salt: str = "1:") -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first 8-digit groups of the
    hex SHA-256 of ``salt`` and the decimal id (a null id: of ``salt`` alone)."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, rate: int = 90, spm: int = 20) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of every row of ``docs(doc_id, text)``.

    * ``rate`` in a hundred texts are transformed, ``spm`` in a hundred of those
      with the suffix first; which ones, and where they are cut, depends on doc_id only.
    * n: code points.  form: ``psm``, ``spm`` or ``plain``.  plain are a null
      or empty text, one that contains a mark, and those the rate leaves out;
      their output is the text (null: empty), prefix_chars and middle_chars null.
    * repeated rows stay and get the same; an empty table gives an empty table;
      other columns are ignored, whatever their names.  Texts are never cut
      short; a task holds about four times the bytes of the longest."""
    h1, h2, h3, h4 = numbers(F.col("doc_id"))
    find = F.arrow_udf(_cuts, "n long, first long, second long, first_byte long, second_byte long")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), h3.alias("h3"), h4.alias("h4"),
                       find(text.cast("binary"), h1, h2).alias("cut"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    data, first, second = F.col("text").cast("binary"), F.col("cut.first_byte").cast("int"), F.col("cut.second_byte").cast("int")
    size = F.octet_length("text")
    prefix, middle, suffix = (F.substring(data, a + 1, b - a).cast("string")
                              for a, b in ((F.lit(0), first), (first, second), (second, size)))
    output = (F.when(F.col("form") == "plain", F.col("text"))
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    cut = F.when(F.col("form") != "plain", F.col("cut.first")), F.when(F.col("form") != "plain", F.col("cut.second") - F.col("cut.first"))
    return rows.select("doc_id", F.col("cut.n").alias("n"), "form", cut[0].alias("prefix_chars"), cut[1].alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)   # parts hold no mark, nor can one arise at their ends
    one, two, three = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, three, two)).otherwise(F.concat(two, three, one))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: ``fill_in_middle`` with digests in place of the texts."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), v AS (
  SELECT *, ('0x' || substr(x, 1, 8))::UBIGINT::BIGINT % (n + 1) AS a, ('0x' || substr(x, 9, 8))::UBIGINT::BIGINT % (n + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(x, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || substr(x, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, substr(t, 1, least(a, b)) AS pre, substr(t, least(a, b) + 1, abs(a - b)) AS mid, substr(t, greatest(a, b) + 1) AS suf FROM v
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
