"""Quality rules: a learned decision list over native document statistics.

Sequential covering on labelled rows: a rule (a conjunction of thresholds)
grows by the best information gain on two thirds of the rows, is pruned on
the last third, and its rows are set aside before the next rule.  The list is
emitted as one ordered Spark conditional expression.  Everything is DataFrame
expressions; the driver sees counts per statistic and threshold only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import save, table
from playstream.llm.quality import held_out

RULES = 8            # most rules of a list
CONDITIONS = 3       # most thresholds of a rule
PRECISION = 0.9      # least share of label 0 among the pruning rows that a rule rejects
GRID = 24            # thresholds tried for each statistic

_SPACE = " \t\n\x0b\x0c\r"

#: Statistics that rules may use, by expressions over the counts.
MEASURES = {
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "repeats_per_word": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    "upper_per_char": "n_upper / greatest(word_chars, 1)",
    "marks_per_char": "n_marks / greatest(word_chars, 1)",
    "distinct_per_word": "n_distinct / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "n_words": "double(n_words)",
}


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of whole texts (null: no words).

    Equal three-word windows are found by sorting a document's window hashes,
    and only in documents that have a repeated hash."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    df = docs.select("doc_id", words.alias("words"), lines.alias("lines")).withColumn("n_words", F.size("words")).withColumn("packed", F.array_join("words", ""))
    less = lambda marks: (F.length("packed") - F.length(F.regexp_replace("packed", marks, ""))).cast("long")
    windows = F.when(F.col("n_words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice("words", 1, F.greatest(F.col("n_words") - 2, F.lit(0))),
                    lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    df = df.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.length("packed").cast("long").alias("word_chars"),
        less(r"[#*$%&|<>]").alias("n_symbols"), less("[A-Z]").alias("n_upper"), less("!").alias("n_marks"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("windows"))
    # (hash, place) in order, where any hash is found twice
    pairs = F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                   F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("pairs", pairs).drop("windows")
    as_next = F.zip_with("pairs", F.slice("pairs", 2, F.greatest(F.size("pairs"), F.lit(0))), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    df = df.withColumn("same", as_next)
    found = F.zip_with(F.zip_with("same", F.concat(F.array(F.lit(False)), "same"), lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))),
                       "pairs", lambda hit, p: F.when(hit, p["i"]))
    places = F.sort_array(F.filter(found, lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))
    covered = F.aggregate(places, zero, lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["stop"])).alias("n"), (i + 3).alias("stop")), lambda a: a["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("pairs", "same")


#: A condition is (measure, ">=" or "<=", threshold); a rule is a list of them.
Rule = list[tuple[str, str, float]]


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, side, t in rule:
        out = out & (F.col(name) >= t if side == ">=" else F.col(name) <= t)
    return out


def decision(rules: list[Rule]) -> Column:
    """The list as an ordered conditional: the first rule that holds rejects, else the row is kept."""
    out = None
    for rule in rules:
        out = F.when(condition(rule), False) if out is None else out.when(condition(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def _binned(grid: dict[str, list[float]]) -> Column:
    """Of each measure, how many thresholds are at most (lo) and below (hi) the row's value."""
    below = lambda m, ts, test: F.size(F.filter(F.array(*map(F.lit, ts)), lambda t: test(t, F.col(m))))
    return F.array(*[F.struct(F.lit(m).alias("m"), below(m, ts, Column.__le__).alias("lo"), below(m, ts, Column.__lt__).alias("hi")) for m, ts in grid.items()])


def _grow(rows: DataFrame, grid: dict[str, list[float]]) -> Rule:
    """Add the threshold of the largest FOIL gain until no label 1 is covered."""
    rule: Rule = []
    while len(rule) < CONDITIONS:
        got = rows.where(condition(rule)).select("quality", F.explode("bins").alias("b")).groupBy("b.m", "b.lo", "b.hi").agg(
            F.sum(1 - F.col("quality")).alias("p"), F.sum("quality").alias("n")).collect()  # two bins per threshold at most
        first = next(iter(grid))
        p0, n0 = (sum(r[k] for r in got if r["m"] == first) for k in ("p", "n"))
        if not p0 or (rule and not n0):
            break
        best = (1e-9, None)
        for m, ts in grid.items():
            mine = [r for r in got if r["m"] == m]
            for k, t in enumerate(ts):
                # lo > k: at least threshold k; hi <= k: at most threshold k
                for side, inside in ((">=", [r for r in mine if r["lo"] > k]), ("<=", [r for r in mine if r["hi"] <= k])):
                    p, n = sum(r["p"] for r in inside), sum(r["n"] for r in inside)
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                        best = max(best, (gain, (m, side, t)), key=lambda x: x[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def learn(samples: DataFrame) -> list[Rule]:
    """Decision list from ``samples`` with every measure, ``quality`` (0 or 1) and ``part`` (0: pruning rows)."""
    grid_at = [i / (GRID + 1) for i in range(1, GRID + 1)]
    cut = samples.groupBy("quality").agg(*[F.percentile_approx(m, F.lit(grid_at), F.lit(1000)).alias(m) for m in MEASURES]).collect()  # two rows
    grid = {m: sorted({t for r in cut for t in r[m] or []}) for m in MEASURES}
    rules: list[Rule] = []
    if not cut:
        return rules
    samples = save(samples.withColumn("bins", _binned(grid)))
    left = F.lit(True)
    while len(rules) < RULES:
        rule = _grow(samples.where(left & (F.col("part") > 0)), grid)
        if not rule:
            break
        held = samples.where(left & (F.col("part") == 0)).agg(*[
            F.coalesce(F.sum(F.when(condition(rule[:k]), F.lit(1) - F.col("quality") if bad else F.col("quality"))), F.lit(0)).alias(f"{'pn'[not bad]}{k}")
            for k in range(1, len(rule) + 1) for bad in (True, False)]).first()
        worth = lambda k: ((held[f"p{k}"] - held[f"n{k}"]) / max(1, held[f"p{k}"] + held[f"n{k}"]), held[f"p{k}"])
        keep = max(range(1, len(rule) + 1), key=worth)
        if held[f"p{keep}"] < PRECISION * (held[f"p{keep}"] + held[f"n{keep}"]) or not held[f"p{keep}"]:
            break
        rules.append(rule[:keep])
        left = left & ~condition(rules[-1])
    return rules


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``.

    * learns from the labelled rows outside fold 0 of the quality classifier,
      labels other than 0 and 1 ignored; with no rule worth keeping (or no
      labels) every row that passes the base is kept;
    * a null or empty text has no words and fails the base; repeated rows get
      equal verdicts; other columns are ignored; empty gives empty."""
    stats = save(counts(docs).select("*", *[F.expr(e).alias(m) for m, e in MEASURES.items() if m != "n_words"]))
    number = stats.withColumnRenamed("n_words", "words_").withColumn("n_words", F.col("words_").cast("double"))
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality")).where(~held_out(F.col("id")) & F.col("quality").isin(0, 1))
    part = F.crc32(F.concat(F.lit("part"), F.col("doc_id").cast("string"))) % 3
    rules = learn(number.join(known, F.col("doc_id") == F.col("id")).select(*MEASURES, "quality", part.alias("part")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & decision(rules)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
