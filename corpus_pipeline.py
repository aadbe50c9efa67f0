"""A training corpus from raw documents, by five corpus operators in a row.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; its result is written as Parquet and read again.  All but the
last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from playstream.llm.common import discard, recorded, save, table
from playstream.llm.decontaminate import without_contaminated
from playstream.llm.lines import dedup_lines
from playstream.llm.packing import packed
from playstream.llm.quality import accepted
from playstream.llm.simhash import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_tables: list[str] = []   # intermediate tables of the stage that was called last


def _stage(f: Stage) -> Stage:
    """A stage's result is written before the next stage is called, so the
    intermediate tables of the one before go then."""
    @wraps(f)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _tables)
        with recorded(_tables):
            return f(spark, docs, sf_dir)
    return call


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, doesn't reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line equals or nearly equals."""
    return dedup_lines(docs)


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs, words=3, bits=3)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packed(docs)


STAGES = [(f.__name__, f) for f in (quality_classifier, line_dedup, simhash_near_dedup, benchmark_decontamination, best_fit_packing)]

#: SQL has neither the classifier, nor SimHash, nor the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    out = STAGES[-1][1](spark, docs, sf_dir)
    _tables.clear()   # the caller hasn't read the result yet
    return out
