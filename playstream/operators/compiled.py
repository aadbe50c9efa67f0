"""Fitted models as expressions.

``compile_forest`` and ``compile_logistic`` read the parameters of a fitted
MLlib model and give a :class:`CompiledModel`: the probability of class 1 as
one SQL expression over the feature columns.  As a ``Column`` it stays inside
the projection's generated code, needs no vector assembly, and can be pushed
into any query; as text it runs in any engine that knows CASE and exp, which
is how scores are checked by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """Class 1's share of a leaf's training rows."""
    share: float


@dataclass(frozen=True)
class Split:
    """Rows whose feature is at most ``threshold`` go left, all others (NaN too) right."""
    feature: str
    threshold: float
    left: "Leaf | Split"
    right: "Leaf | Split"


@dataclass(frozen=True)
class CompiledModel:
    """Probability of class 1 as SQL text over ``features``; null where one of them is null."""
    features: tuple[str, ...]
    sql: str

    def column(self) -> Column:
        return F.expr(self.sql)

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.column())


def _number(x: float) -> str:
    """A double literal that Spark and others read back exactly; with an exponent, else it would be a decimal."""
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{'NaN' if x != x else 'Infinity' if x > 0 else '-Infinity'}' AS DOUBLE)"
    return f"{x:.17e}"


def _double(name: str) -> str:
    return f"CAST({name} AS DOUBLE)"


def tree_sql(node: "Leaf | Split") -> str:
    if isinstance(node, Leaf):
        return _number(node.share)
    left, right = tree_sql(node.left), tree_sql(node.right)
    if left == right:   # a split of no effect on the probability
        return left
    return f"CASE WHEN {_double(node.feature)} <= {_number(node.threshold)} THEN {left} ELSE {right} END"


def forest(trees: Sequence["Leaf | Split"], features: Sequence[str]) -> CompiledModel:
    """The mean of the trees' shares, each tree counting alike."""
    known = " AND ".join(f"{f} IS NOT NULL" for f in features)
    total = " + ".join(f"({tree_sql(t)})" for t in trees)
    return CompiledModel(tuple(features), f"CASE WHEN {known} THEN ({total}) / {_number(float(len(trees)))} END")


def logistic(intercept: float, coefficients: Sequence[float], features: Sequence[str]) -> CompiledModel:
    margin = " + ".join([_number(intercept)] + [f"{_number(c)} * {_double(f)}" for c, f in zip(coefficients, features, strict=True)])
    return CompiledModel(tuple(features), f"({_number(1.0)} / ({_number(1.0)} + exp(-({margin}))))")


def _node(node, features: Sequence[str]) -> "Leaf | Split":
    """A node of a fitted tree, read from the model in the JVM."""
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        total = sum(stats)
        return Leaf(stats[1] / total if len(stats) > 1 and total else 0.0)
    split = node.split()
    if not split.getClass().getSimpleName().startswith("Continuous"):
        raise ValueError("only trees over continuous features can be compiled")
    return Split(features[split.featureIndex()], split.threshold(), _node(node.leftChild(), features), _node(node.rightChild(), features))


def compile_tree(model: DecisionTreeClassificationModel, features: Sequence[str]) -> "Leaf | Split":
    return _node(model._call_java("rootNode"), features)


def compile_forest(model: RandomForestClassificationModel, features: Sequence[str]) -> CompiledModel:
    """Class 1's probability: every tree's share at the row's leaf, averaged as the model does."""
    return forest([compile_tree(t, features) for t in model.trees], features)


def compile_logistic(model: LogisticRegressionModel, features: Sequence[str]) -> CompiledModel:
    if model.numClasses > 2:
        raise ValueError("only two classes can be compiled")
    return logistic(model.intercept, model.coefficients.toArray().tolist(), features)


def compile_model(model: PipelineModel) -> CompiledModel:
    """A fitted pipeline of a vector assembler and a forest or logistic regression."""
    assembler, last = model.stages
    features = assembler.getInputCols()
    if isinstance(last, RandomForestClassificationModel):
        return compile_forest(last, features)
    if isinstance(last, LogisticRegressionModel):
        return compile_logistic(last, features)
    raise ValueError(f"can't compile {type(last).__name__}")
