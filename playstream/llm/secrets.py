"""Secret scan: fixed patterns, and character Markov models of random strings
and ordinary identifiers compared by log-likelihood ratio.

Native: DataFrame expressions only.  The models' transition counts come from
labelled samples: the values that the fixed patterns find are random strings,
long tokens of the text beside them that recur are identifiers (a stray secret
doesn't).  Tokens are counted over all documents; the driver sees the counts
per character pair, and the ratio above which a token counts as random: the
one that nine in ten of the random samples of a fold reach that the models
haven't learned from, and zero at least (as likely random as not).
"""

from __future__ import annotations

import json
import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import save, table

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

SYMBOLS = string.ascii_letters + string.digits + "+/_-"
TOKEN = "[A-Za-z0-9+/_-]"
LEAST_CHARS = 12     # least length of a token that the models learn from and judge
BACK_OFF = 256       # weight of a character's own probability beside its pair counts
COMMON = 5           # least occurrences of a token that counts as an identifier
FOLDS = 5            # of the random samples, one is held out to set the threshold
RECALL = 0.9         # share of the random samples that the threshold keeps
_CHUNK = 256         # matches whose places are added up together


def _spans(text: Column, pattern: str, kind: str, passes) -> Column:
    """Spans of the leftmost non-overlapping matches that pass, found from the
    lengths of the matches and of the text between them."""
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    item = "struct<start:int,kind:int,stop:int>"

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        stop = start + F.coalesce(F.length(s["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(F.coalesce(passes(s["hit"]), F.lit(False)), F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    # places are running sums: over chunks first, then inside each, so that no long list is copied at every match
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(_CHUNK)), lambda i: F.slice(steps, i, F.lit(_CHUNK)))
    length = lambda s: s["gap"] + F.coalesce(F.length(s["hit"]), F.lit(0))
    sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + length(s)))
    ats = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(sizes, ats, lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
    none = F.array().cast(f"array<{item}>")
    found = F.flatten(F.zip_with(chunks, starts, lambda c, at: F.aggregate(c, F.struct(at.alias("at"), none.alias("out")), step, lambda a: a["out"])))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` (null: empty) and the fixed patterns' spans by kind."""
    text = F.col("text")
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("assign", _spans(text, ASSIGN, "assign", value))
            .withColumn("access", _spans(text, ACCESS, "access", lambda hit: F.length(hit) >= 18))
            .withColumn("hex", _spans(text, HEX, "hex", lambda hit: F.length(hit) >= 16)))


def samples(found: DataFrame) -> DataFrame:
    """``(token, random, n)``: the distinct labelled tokens of the corpus and
    their counts; identifiers are taken from the text without what the patterns match."""
    cut = lambda s: F.substr(F.col("text"), s["start"] + 1, s["stop"] - s["start"])
    values = F.concat(F.transform("assign", lambda s: F.regexp_extract(cut(s), ASSIGN, 2)), F.transform("access", cut), F.transform("hex", cut))
    token = F.lit(f"{TOKEN}{{{LEAST_CHARS},}}")
    rest = F.when(F.size(values) > 0, F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")).otherwise(F.col("text"))
    known = found.select(values.alias("values"), F.regexp_extract_all(rest, token, F.lit(0)).alias("tokens"))
    part = known.select(F.explode(F.concat(
        F.transform("values", lambda v: F.struct(v.alias("token"), F.lit(True).alias("random"))),
        F.transform("tokens", lambda v: F.struct(v.alias("token"), F.lit(False).alias("random"))))).alias("s"))
    return part.groupBy("s.token", "s.random").agg(F.count("*").alias("n"))


def held_out(token: Column) -> Column:
    return F.crc32(token.cast("binary")) % FOLDS == 0


def learned(labelled: DataFrame) -> DataFrame:
    """The samples that the models learn from."""
    return labelled.where(F.when(F.col("random"), ~held_out(F.col("token"))).otherwise(F.col("n") >= COMMON))


def threshold(labelled: DataFrame, table_: list[float], recall: float = RECALL) -> float:
    """The ratio above which a token counts as random: the highest that a share
    of ``recall`` of the distinct held-out random samples reaches (a quantile,
    approximate to a ten-thousandth), zero at least.  Without a held-out sample
    all random ones set it; without any it is infinite."""
    ratio, token = mean_ratio(F.col("token"), table_), F.col("token")
    low = lambda x: F.percentile_approx(x, 1 - recall, 10000)
    row = labelled.where(F.col("random") & (F.length("token") >= LEAST_CHARS)).agg(F.coalesce(low(F.when(held_out(token), ratio)), low(ratio)).alias("t")).first()
    return float("inf") if row.t is None else max(row.t, 0.0)


def ratios(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios random : identifier of a character after another,
    flattened by position in ``SYMBOLS``.  A pair's probability backs off to its
    second character's, that to a uniform one: without samples the models are equal."""
    chars = F.split("token", "")
    pair = F.explode(F.zip_with(chars, F.slice(chars, 2, F.length("token")), lambda a, b: F.concat(a, b)))
    rows = (labelled.select("random", "n", pair.alias("pair")).where(F.col("pair").isNotNull())
            .groupBy("random", "pair").agg(F.sum("n").alias("n")).collect())  # symbols squared, twice, at most
    v = len(SYMBOLS)
    pairs: dict[bool, dict[str, int]] = {True: {}, False: {}}
    for r in rows:
        if len(r["pair"]) == 2 and r["pair"][0] in SYMBOLS and r["pair"][1] in SYMBOLS:
            pairs[r["random"]][r["pair"]] = r["n"]
    after = {k: {a: sum(pairs[k].get(a + b, 0) for b in SYMBOLS) for a in SYMBOLS} for k in pairs}
    alone = {k: {b: sum(pairs[k].get(a + b, 0) for a in SYMBOLS) for b in SYMBOLS} for k in pairs}
    single = {k: {b: (alone[k][b] + 1) / (sum(alone[k].values()) + v) for b in SYMBOLS} for k in pairs}
    log = lambda k, a, b: math.log((pairs[k].get(a + b, 0) + BACK_OFF * single[k][b]) / (after[k][a] + BACK_OFF))
    return [round(log(True, a, b) - log(False, a, b), 4) for a in SYMBOLS for b in SYMBOLS]


def mean_ratio(token: Column, table_: list[float]) -> Column:
    """Mean log-likelihood ratio over the token's character pairs, by look-ups in
    two literal arrays; a pair with a character that is no symbol tells nothing."""
    place = F.from_json(F.lit(json.dumps([SYMBOLS.find(chr(c)) if chr(c) in SYMBOLS else None for c in range(128)])), "array<int>")
    values = F.from_json(F.lit(str(table_)), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.get(place, F.ascii(c)))
    pairs = F.zip_with(F.slice(codes, 1, F.greatest(F.length(token) - 1, F.lit(0))), F.slice(codes, 2, F.length(token)), lambda a, b: F.coalesce(F.get(values, a * len(SYMBOLS) + b), F.lit(0.0)))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.length(token) - 1, F.lit(1))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row of ``docs``.

    * spans are kind:start:end in code points, end exclusive, by start and
      then by kind as listed; the base's hash covers its own spans only;
    * the models add spans (kind markov) of tokens of ``LEAST_CHARS`` and more
      that no base span touches;
    * null and empty texts have no span; repeated rows get equal rows; other
      columns are ignored; an empty table gives an empty table."""
    found = save(base_spans(docs))
    labelled = save(samples(found))
    table_ = ratios(learned(labelled))
    least = threshold(labelled, table_)
    judged = lambda hit: mean_ratio(hit, table_) >= F.lit(least)
    base = F.sort_array(F.concat("assign", "access", "hex"))
    df = found.withColumn("base", base).withColumn("more", _spans(F.col("text"), f"{TOKEN}{{{LEAST_CHARS},}}", "markov", judged))
    added = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    names = F.array(*map(F.lit, KINDS))
    show = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return df.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(show(F.col("base")), 256).alias("base_sha256"), show(F.sort_array(F.concat("base", added))).alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
