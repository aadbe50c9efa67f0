"""Compiled models give what the fitted ones do."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from playstream.functions import positive_prob
from playstream.operators.compiled import Leaf, Split, compile_model, forest, logistic, tree_sql
from tools.oracle_check import duck
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def rows(spark):
    d = spark.range(4000).select((F.hash("id", F.lit(1)) % 50).alias("a"), (F.hash("id", F.lit(2)) / 2 ** 20).alias("b"), (F.col("id") % 7).cast("float").alias("c"))
    label = (F.col("a") + F.col("b") / 100 + F.hash("a", "b") % 20 > 3).cast("int")
    return d.withColumn("label", label).repartition(2).checkpoint(eager=True)


def farthest(rows, model):
    out = model.transform(rows).withColumn("p", positive_prob("probability"))
    out = compile_model(model).transform(out, "q")
    return out.agg(F.max(F.coalesce(F.abs(F.col("p") - F.col("q")), F.lit(9.0)))).first()[0], out.select("q").distinct().count()


@pytest.mark.parametrize("kind,options", [(RandomForestClassifier, {"numTrees": 50, "seed": 3}), (RandomForestClassifier, {"numTrees": 7, "maxDepth": 9, "seed": 4}),
                                          (LogisticRegression, {"maxIter": 20}), (LogisticRegression, {"maxIter": 5, "regParam": 0.1, "fitIntercept": False})])
def test_equals_the_fitted_pipeline(rows, kind, options):
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), kind(**options)]).fit(rows)
    gap, values = farthest(rows, model)
    assert gap <= 1e-9 and values > 20


@pytest.mark.parametrize("label", [0, 1])
def test_models_of_one_class(rows, label):
    one = rows.limit(200).withColumn("label", F.lit(label))
    for last in (RandomForestClassifier(numTrees=3), LogisticRegression()):
        model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), last]).fit(one)
        assert farthest(one, model)[0] <= 1e-9


def test_odd_values_and_nulls(spark):
    m = forest([Split("a", 1.5, Leaf(0.25), Split("b", float("inf"), Leaf(0.5), Leaf(1.0))), Leaf(0.0)], ["a", "b"])
    odd = spark.createDataFrame([(1.5, 0.0), (1.6, float("inf")), (float("nan"), float("nan")), (None, 1.0)], "a double, b double")
    assert [r[0] for r in odd.select(m.column()).collect()] == [0.125, 0.25, 0.5, None]
    assert tree_sql(Split("a", 0.0, Leaf(0.5), Leaf(0.5))) == tree_sql(Leaf(0.5))
    assert spark.createDataFrame([(None,)], "a double").select(logistic(0.5, [1.0], ["a"]).column()).first()[0] is None


def test_the_text_runs_elsewhere(spark):
    """The same expression in DuckDB over a table both read."""
    m = logistic(-1.25, [0.01, -3e-4], ["l_quantity", "l_extendedprice"])
    f = forest([Split("l_quantity", 24.5, Leaf(0.1), Split("l_extendedprice", 30000.25, Leaf(0.3), Leaf(1 / 3)))], ["l_quantity", "l_extendedprice"])
    query = f"SELECT sum({m.sql}) AS a, sum({f.sql}) AS b FROM lineitem"
    spark.read.parquet(f"{SF0001}/lineitem.parquet").createOrReplaceTempView("lineitem")
    here, there = spark.sql(query).first(), duck(SF0001).execute(query).fetchall()[0]
    assert all(abs(x - y) < 1e-6 * abs(y) for x, y in zip(here, there))


def test_what_cannot_be_compiled(rows):
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), DecisionTreeClassifier()]).fit(rows)
    with pytest.raises(ValueError):
        compile_model(model)
