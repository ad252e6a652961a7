"""Batch scoring and model training (EVL-06, EVL-10..12, UDX-06).

Scoring never leaves the executors: a ``pyspark.ml`` model is a plan
operator (``transform``), an opaque Python model runs in ``mapInPandas``
(Arrow batches, model built once per task), and a linear model is a column
expression.  Training is re-aimed at ``pyspark.ml`` (the reference trains
PyTorch networks on one machine).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_score(df: DataFrame, weights: dict[str, float], bias: float = 0.0, missing: str = "fail") -> DataFrame:
    """EVL-06: logistic score of a linear model as a column expression; class = score >= 0.5.

    ``missing='fail'`` raises when a feature column is absent, ``'zero'`` uses 0.0.
    """
    z = F.lit(bias)
    for c, w in weights.items():
        if c not in df.columns:
            if missing == "fail":
                raise ValueError(f"missing feature column {c}")
            continue
        z = z + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w)
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.withColumn("prediction_score", s).withColumn("prediction_class", (s >= 0.5).cast("int"))


def score_with_pipeline(df: DataFrame, model: PipelineModel, id_col: str, model_version: str,
                        scored_at: str, keep: Sequence[str] = ()) -> DataFrame:
    """EVL-06: transform with a fitted pipeline; positive-class probability, argmax class,
    per-class probabilities, id, optional features, version and scoring time."""
    out = model.transform(df)
    prob = vector_to_array("probability")
    return out.select(
        id_col, *keep,
        prob[1].alias("prediction_score"),
        F.col("prediction").cast("int").alias("prediction_class"),
        prob.alias("class_probabilities"),
        F.lit(model_version).alias("model_version"),
        F.to_timestamp(F.lit(scored_at)).alias("scored_at"),
    )


def score_with_python(df: DataFrame, make_model: Callable[[], Callable[[pd.DataFrame], pd.Series]],
                      features: Sequence[str], id_col: str) -> DataFrame:
    """UDX-06 / SRC-10: an opaque Python model applied to Arrow batches.

    ``make_model`` runs once per task (load weights there); input splits are
    Spark's own, so a file larger than memory is scored without a chunk loop.
    """
    cols = [id_col, *features]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for pdf in batches:
            missing = [c for c in features if c not in pdf.columns]
            if missing:
                raise ValueError(f"missing features {missing}")
            score = model(pdf[list(features)]).astype("float64")
            yield pd.DataFrame({id_col: pdf[id_col], "prediction_score": score,
                                "prediction_class": (score >= 0.5).astype("int32")})

    schema = f"{id_col} {dict(df.dtypes)[id_col]}, prediction_score double, prediction_class int"
    return df.select(*cols).mapInPandas(run, schema)


def train_classifier(train: DataFrame, features: Sequence[str], label: str, kind: str = "logistic",
                     hidden: Sequence[int] = (64, 32), seed: int = 42, max_iter: int = 50) -> PipelineModel:
    """EVL-10: assembler + scaler + classifier (logistic regression or an MLP)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep")
    sc = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    if kind == "mlp":
        clf = MultilayerPerceptronClassifier(layers=[len(features), *hidden, 2], labelCol=label, seed=seed,
                                             maxIter=max_iter)
    else:
        clf = LogisticRegression(labelCol=label, maxIter=max_iter)
    return Pipeline(stages=[asm, sc, clf]).fit(train)


def train_implicit_als(interactions: DataFrame, user: str, item: str, weight: str, rank: int = 16,
                       seed: int = 42, max_iter: int = 10):
    """EVL-11: implicit-feedback ALS; user and item factors come back as array columns."""
    from tidewater.session import ensure_checkpoint_dir

    # ALS checkpoints its factor lineage every few iterations into the shared checkpoint folder
    ensure_checkpoint_dir(interactions.sparkSession)
    als = ALS(userCol=user, itemCol=item, ratingCol=weight, implicitPrefs=True, rank=rank, seed=seed,
              maxIter=max_iter, coldStartStrategy="drop", nonnegative=False, checkpointInterval=5)
    return als.fit(interactions)


def factor_tables(model) -> tuple[DataFrame, DataFrame]:
    """EVL-12: (user_id, user_vec) and (item_id, item_vec) tables from a fitted ALS model."""
    u = model.userFactors.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("user_vec"))
    i = model.itemFactors.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("item_vec"))
    return u, i
