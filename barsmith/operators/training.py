"""Two classifiers over the feature table: boosted trees and a random forest."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from barsmith.operators import balance, boosting, evaluation, forest
from barsmith.operators.boosting import BoostedModel, BoostParams
from barsmith.operators.evaluation import CLASSES, PROBABILITIES
from barsmith.operators.forest import ForestModel, ForestParams
from barsmith.session import scratch, shared_dir


#: Rows up to which a forest is Spark's: beyond that its numbers per row and tree fill memory.
SPARK_FOREST_ROWS = 65_536


# Depth, learning rate, rounds, smallest child, row share, column share.
TUNING_COMBINATIONS = [
    BoostParams(*row) for row in [
        (5, 0.05, 800, 1, 0.8, 0.8),
        (4, 0.1, 500, 3, 0.9, 0.9),
        (6, 0.03, 1000, 1, 0.8, 0.8),
        (5, 0.05, 1000, 3, 0.9, 0.8),
        (4, 0.05, 800, 1, 0.8, 0.9),
        (7, 0.3, 1500, 5, 0.7, 0.7),
        (2, 0.01, 500, 9, 0.6, 0.6),
        (1, 0.5, 800, 7, 0.5, 0.5),
        (8, 0.1, 150, 3, 0.9, 0.6),
        (6, 0.05, 1000, 5, 0.7, 0.9),
    ]
]
WEIGHTED_TRAINING = BoostParams(max_depth=6, row_share=0.8, column_share=0.8)


def feature_vector(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """One vector column; a missing value is an error rather than a silent zero."""
    return VectorAssembler(
        inputCols=features, outputCol=output, handleInvalid="error").transform(df)


def run_together(tasks: list[Callable]) -> list:
    """Run independent fits at the same time; their jobs share the cluster."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def fit_boosted(train: DataFrame, features: list[str], params: BoostParams = BoostParams(),
                weight: str | None = None, validation: DataFrame | None = None, patience: int = 50) -> BoostedModel:
    """Boosted trees for three classes. With ``validation`` training ends after ``patience`` rounds without
    a smaller loss there and keeps the rounds up to the least one."""
    return boosting.fit_models(train, features, [params], weight, validation, patience)[0]


def fit_weighted(train: DataFrame, validation: DataFrame, features: list[str],
                 params: BoostParams = WEIGHTED_TRAINING, patience: int = 50) -> BoostedModel:
    """Balanced weights, and rounds that stop on the validation part."""
    weighted = balance.add_weights(train, balance.class_weights(train))
    return fit_boosted(weighted, features, params, "weight", validation, patience)


def fit_forest(train: DataFrame, features: list[str],
               params: ForestParams = ForestParams(), spark_rows: int = SPARK_FOREST_ROWS) -> PipelineModel | ForestModel:
    """Random forest with balanced class weights, as a pipeline with its assembler; of more than ``spark_rows``
    rows one on binned rows."""
    sizes = balance.class_sizes(train)
    weights = balance.weights_of(sizes)
    if sum(sizes.values()) > spark_rows and set(sizes) <= set(CLASSES):
        return forest.fit(train, features, weights, params)
    _allow_checkpoints(train)
    weighted = balance.add_weights(train, weights)
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    classifier = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=params.trees,
        maxDepth=params.max_depth, minInstancesPerNode=params.min_leaf_rows,
        featureSubsetStrategy="sqrt", seed=params.seed, cacheNodeIds=True,
    )
    data = weighted.withColumn("label", F.col("label").cast("double"))
    return Pipeline(stages=[assembler, classifier]).fit(data)


def forest_probabilities(model: PipelineModel | ForestModel, df: DataFrame, prefix: str = "") -> DataFrame:
    """Three probability columns; classes the model never saw get 0."""
    if isinstance(model, ForestModel):
        return model.transform(df, prefix)
    scored = model.transform(df)
    p = vector_to_array("probability")
    return scored.select(
        *df.columns,
        *[F.coalesce(F.get(p, F.lit(c)), F.lit(0.0)).alias(prefix + name)
          for c, name in zip(CLASSES, PROBABILITIES, strict=True)],
    )


def score_ensemble(df: DataFrame, boosted: BoostedModel, forest_model: PipelineModel | ForestModel) -> DataFrame:
    """Both models' probabilities, their blend and the decision."""
    both = forest_probabilities(forest_model, boosted.transform(df, "boost_"), "forest_")
    return evaluation.blend(both)


def tune(train: DataFrame, validation: DataFrame, features: list[str],
         combinations: list[BoostParams] = TUNING_COMBINATIONS) -> list[dict]:
    """Balanced accuracy per combination, best first marked; equal scores keep the earlier one.

    All models grow together on one binned table, a pass over the rows for each level of all of them.
    """
    weighted = balance.add_weights(train, balance.class_weights(train))

    def score(model: BoostedModel) -> Row:
        return evaluation.balanced_accuracy(evaluation.threshold_rule(model.transform(validation))).first()

    models = boosting.fit_models(weighted, features, combinations, "weight")
    scores = run_together([lambda m=m: score(m) for m in models]) if models else []
    results, best, best_score = [], None, 0.0
    for i, row in enumerate(scores):
        results.append({"combination": i, "balanced_accuracy": row["balanced_accuracy"],
                        "accuracy": row["accuracy"]})
        if row["balanced_accuracy"] > best_score:
            best, best_score = i, row["balanced_accuracy"]
    return [{**r, "is_best": r["combination"] == best} for r in results]


def _allow_checkpoints(df: DataFrame) -> None:
    """Long boosting runs cut their lineage in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))


def route(matched: DataFrame, registry: dict[tuple, Callable[[DataFrame], DataFrame]],
          keys: tuple[str, ...]) -> DataFrame:
    """Score rows by the model registered for their key; others keep null probabilities.

    Every model is loaded once by the caller. The input is written once, divided by key, so
    each branch reads only the files of its own key.
    """
    spark = matched.sparkSession
    path = scratch(spark, "routed")
    matched.write.partitionBy(*keys).parquet(path)
    kept = spark.read.schema(matched.schema).parquet(path).select(*matched.columns)
    known, parts = F.lit(False), []
    for values, score in registry.items():
        own = F.col("found")
        for column, value in zip(keys, values, strict=True):
            own = own & (F.col(column) == value)
        known = known | own
        parts.append(score(kept.where(own)))
    rest = kept.where(~F.coalesce(known, F.lit(False))).withColumn(
        "probabilities", F.lit(None).cast("array<double>"))
    for part in parts:
        rest = rest.unionByName(part)
    return rest
