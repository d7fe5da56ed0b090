"""Tabular models on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.features import rolling_features


def split_by_key(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run and after every retry."""
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    return df.filter(place < int(train_share * 10_000)), df.filter(place >= int(train_share * 10_000))


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], *drop: str) -> DataFrame:
    """All rows of ``df`` with the model's columns; rows with a NULL feature keep their place, with NULL there."""
    complete = F.lit(True)
    for feature in features:
        complete = complete & F.col(f"`{feature}`").isNotNull()
    done = model.transform(df.filter(complete)).drop(*drop)
    return done.unionByName(df.filter(~complete), allowMissingColumns=True)


def train_tabular(
    df: DataFrame, features: Sequence[str], label: str, kind: str = "linear", key: str = "id", seed: int = 42,
    trees: int = 100, depth: int = 15, iterations: int = 50, holdout: Column | None = None,
) -> tuple[PipelineModel, float]:
    """Fit ``linear``, ``forest`` or ``classifier``; returns the model and RMSE (accuracy for the classifier) on held-out rows.

    Rows that meet ``holdout`` are held out; without it a fifth of the keys, by a hash.
    """
    estimators = {
        "linear": lambda: LinearRegression(featuresCol="features", labelCol=label, maxIter=iterations),
        "forest": lambda: RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed),
        "classifier": lambda: RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed),
    }
    train, test = split_by_key(df, key, seed=seed) if holdout is None else (df.filter(~holdout), df.filter(holdout))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    model = Pipeline(stages=[assembler, estimators[kind]()]).fit(train)
    if kind == "classifier":
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    else:
        evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    return model, evaluator.evaluate(model.transform(test))


def fraud_training_set(
    tx: DataFrame, key: str, ts: str, row_id: str, value: str, amount_limit: float = 1000, hourly_limit: int = 5,
    hot_rows: int | None = None,
) -> DataFrame:
    """Hourly and daily velocity with the label rule: a large amount or too many transactions in an hour."""
    rolled = rolling_features(tx, key, ts, row_id, value, {"1h": 3600, "24h": 86400}, hot_rows)
    return rolled.select(
        row_id, key, F.col(value).alias("amount"),
        F.col("count_1h").alias("velocity_1h"), F.col("count_24h").alias("velocity_24h"),
        F.when((F.col(value) > amount_limit) | (F.col("count_1h") > hourly_limit), 1).otherwise(0).alias("is_fraud"),
    )


def cluster_users(df: DataFrame, features: Sequence[str], k: int = 5, iterations: int = 20, seed: int = 42) -> tuple[DataFrame, PipelineModel]:
    """K-means over standardised features; returns all rows with ``cluster``, NULL where a feature is NULL, and the model."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="skip"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True),
        KMeans(featuresCol="__scaled", predictionCol="cluster", k=k, maxIter=iterations, seed=seed),
    ]
    model = Pipeline(stages=stages).fit(df)
    return predict(model, df, features, "__raw", "__scaled"), model


def centre_distances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``distances``, the squared distance to every centre of a model of ``cluster_users``, in the scaled space."""
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    scaled = model.transform(df).withColumn("__at", vector_to_array("__scaled"))

    def distance(centre: list[float]) -> Column:
        return F.aggregate(F.zip_with("__at", F.array(*[F.lit(x) for x in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)

    return scaled.withColumn("distances", F.array(*[distance(c) for c in centres])).drop("__raw", "__scaled", "__at")


def cluster_sizes(model: PipelineModel) -> list[int]:
    last = model.stages[-1]
    assert isinstance(last, KMeansModel)
    return last.summary.clusterSizes
