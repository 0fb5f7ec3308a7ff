"""Machine-learning steps on tables, all on the distributed MLlib."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame, functions as F


def split_rows(df: DataFrame, key: str, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run and layout."""
    bucket = F.pmod(F.xxhash64(key), F.lit(10))
    return df.where(bucket < train_tenths), df.where(bucket >= train_tenths)


def linear_fit(df: DataFrame, features: list[str], label: str) -> LinearRegressionModel:
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    return LinearRegression(featuresCol="features", labelCol=label).fit(vectors)


def tree_stages(
    categories: list[str], numbers: list[str], label: str, max_depth: int = 8, max_bins: int = 32
) -> Pipeline:
    """Index the categories, assemble the features, classify with a decision tree.

    ``max_bins`` must cover the largest number of categories.
    """
    indexed = [f"{c}_idx" for c in categories]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"),
            VectorAssembler(inputCols=indexed + numbers, outputCol="features"),
            DecisionTreeClassifier(
                featuresCol="features", labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=42
            ),
        ]
    )


def evaluate(predictions: DataFrame, label: str, metrics: list[str]) -> dict[str, float]:
    """Metrics by name (``f1``, ``accuracy``, ``weightedPrecision``, …)."""
    pairs = predictions.select(F.col(label).cast("double").alias(label), "prediction")
    return {
        m: MulticlassClassificationEvaluator(labelCol=label, metricName=m).evaluate(pairs) for m in metrics
    }


def confusion(predictions: DataFrame, label: str) -> DataFrame:
    """Rows per label and prediction; every metric of the evaluator follows from it."""
    return predictions.groupBy(F.col(label).cast("double").alias("label"), "prediction").count()


def search(
    train: DataFrame, pipeline: Pipeline, label: str, depths: list[int], bins: list[int], parallelism: int = 4
) -> TrainValidationSplitModel:
    """Fit each setting of the tree on one split and keep the best.

    The stages before the tree don't depend on its settings: they are fitted once, on all of ``train`` (the part kept
    for validation included), and every fit of the tree reads the feature vectors they gave.
    """
    *features, tree = pipeline.getStages()
    prepared = Pipeline(stages=features).fit(train)
    vectors = prepared.transform(train).select(tree.getFeaturesCol(), label)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, depths).addGrid(tree.maxBins, bins).build()
    found = TrainValidationSplit(
        estimator=tree,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=label),
        trainRatio=0.8,
        seed=42,
        parallelism=parallelism,
    ).fit(vectors)
    found.bestModel = PipelineModel([*prepared.stages, found.bestModel])
    return found


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
