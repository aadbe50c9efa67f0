"""Win-probability and MVP models: features, fit, save/load, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.functions import display_pct, positive_prob, stamp
from playstream.operators.compiled import CompiledModel
from playstream.operators.moments import by_moment, dedupe_moments, share_of_total
from playstream.schemas import SNAP_FIELDS, to_reference_names

# Feature lists and model sizes.
WIN_FEATURES = ["score_diff", "seconds_remaining"]
MVP_FEATURES = ["pts", "ast", "reb", "stl", "blk", "tov", "pf", "fg_pct", "efficiency_norm"]
WIN_TREES = 50
MVP_ITERATIONS = 20
SCORED_FIELDS = ["@timestamp", *SNAP_FIELDS, "win_pct", "mvp_pct"]


def win_features(out: str = "features_win") -> VectorAssembler:
    """Score difference and seconds remaining; nulls are an error (M3)."""
    return VectorAssembler(inputCols=WIN_FEATURES, outputCol=out, handleInvalid="error")


def mvp_features(out: str = "features_mvp") -> VectorAssembler:
    """Box-score counters, fg% and team-normalised efficiency (M4)."""
    return VectorAssembler(inputCols=MVP_FEATURES, outputCol=out, handleInvalid="error")


def train_win(df: DataFrame, seed: int = 42, label: str = "label_win") -> PipelineModel:
    """Random forest of 50 trees on the win features (M5)."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features_win", numTrees=WIN_TREES, seed=seed)
    return Pipeline(stages=[win_features(), rf]).fit(df)


def train_mvp(df: DataFrame, label: str = "label_mvp") -> PipelineModel:
    """Logistic regression, 20 iterations, no regularisation (M6)."""
    lr = LogisticRegression(labelCol=label, featuresCol="features_mvp", maxIter=MVP_ITERATIONS)
    return Pipeline(stages=[mvp_features(), lr]).fit(df)


def train_models(training: DataFrame, seed: int = 42) -> tuple[PipelineModel, PipelineModel]:
    """Fit both models over one cached copy of the columns they read."""
    t = training.select(*dict.fromkeys([*WIN_FEATURES, *MVP_FEATURES, "label_win", "label_mvp"])).persist()
    try:
        return train_win(t, seed), train_mvp(t)
    finally:
        t.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, replacing what is there (K7)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)


_ML_COLS = ["rawPrediction", "probability", "prediction"]


#: What scores rows: a fitted pipeline, or its compiled form.
Model = PipelineModel | CompiledModel


def _probability(df: DataFrame, model: Model, out: str, features: str) -> DataFrame:
    """Class-1 probability by either form of a model.

    A fitted pipeline counts null features as 0, as its training set does
    (P13): a game may have one team only, so no score difference.  The rows
    keep their nulls."""
    if isinstance(model, CompiledModel):
        return model.transform(df, out)
    own = {c: f"_own_{c}" for c in model.stages[0].getInputCols()}
    filled = df.withColumns({o: F.col(c) for c, o in own.items()}).na.fill(0, list(own))
    scored = model.transform(filled).withColumn(out, positive_prob("probability")).drop(*_ML_COLS, features)
    return scored.withColumns({c: F.col(o) for c, o in own.items()}).drop(*own.values())


def score_win(df: DataFrame, model: Model, out: str = "win_prob") -> DataFrame:
    """Class-1 probability of the win model (M8)."""
    return _probability(df, model, out, "features_win")


def score_mvp(df: DataFrame, model: Model) -> DataFrame:
    """MVP probability and its share of the game's total at that moment, x100 (M9)."""
    d = share_of_total(df, "efficiency", ("game_id", "team_code", "seconds_remaining"), "efficiency_norm",
                       exact_scale=2)
    d = _probability(d, model, "mvp_prob", "features_mvp").drop("efficiency_norm")
    return share_of_total(d, "mvp_prob", ("game_id", "seconds_remaining"), "mvp_share", percent=True)


def score_columns(df: DataFrame) -> DataFrame:
    """Final 21-column scored projection."""
    fields = [c for c in SNAP_FIELDS if c in df.columns or c != "shots"]
    return df.select(stamp().alias("@timestamp"), *fields,
                     display_pct(F.col("win_prob") * 100).alias("win_pct"),
                     display_pct("mvp_share").alias("mvp_pct"))


def score(df: DataFrame, win: Model, mvp: Model,
          dedupe_keys=("game_id", "player_name", "team_code", "seconds_remaining"),
          reference_names: bool = False) -> DataFrame:
    """Dedupe -> win probability -> MVP share -> 21 scored columns.
    ``reference_names`` renames the columns to the reference's document fields."""
    d = dedupe_moments(by_moment(df), dedupe_keys, latest="snapshot_id" if "snapshot_id" in df.columns else None)
    out = score_columns(score_mvp(score_win(d, win), mvp))
    return to_reference_names(out) if reference_names else out
