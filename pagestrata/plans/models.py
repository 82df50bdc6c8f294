"""Tree models on page features, and the registry of classifiers."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evidence import evidence
from ..operators.labels import softmax
from ..operators.pages import cascade, features, segment_stats

_classifiers: dict[str, Callable[..., DataFrame]] = {"baseline": cascade}


def register_classifier(name: str, classify: Callable[..., DataFrame]) -> None:
    """Plug in a classifier (pages, segments) -> doc_id, page, label: a tree, layout or vision model."""
    _classifiers[name.lower()] = classify


def classifier(name: str) -> Callable[..., DataFrame]:
    if name.lower() not in _classifiers:
        raise ValueError(f"no classifier of that name: {name}")
    return _classifiers[name.lower()]


def feature_names(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in ("doc_id", "page", "target")]


def random_forest(trees: int = 150, depth: int = 30, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="target", featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="log2", seed=seed)


def boosted_trees(rounds: int = 100, depth: int = 6, rate: float = 0.1, share: float = 0.8, seed: int = 42) -> OneVsRest:
    return OneVsRest(labelCol="target", featuresCol="features", classifier=GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=share, seed=seed))


def train(features: DataFrame, estimator):
    """Fitted pipeline on features with a numeric target."""
    return Pipeline(stages=[VectorAssembler(inputCols=feature_names(features), outputCol="features"), estimator]).fit(features)


def importance(model, names: list[str]) -> list[tuple[str, float]]:
    """Feature and importance, greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, values), strict=True), key=lambda x: (-x[1], x[0]))


def page_features(pages: DataFrame, segs: DataFrame) -> DataFrame:
    """The 17 features of pages with words and lang, from the same evidence for training and for prediction; short segments count."""
    return features(evidence(pages, shape=True), segment_stats(segs, ("doc_id", "page")))


def with_targets(found: DataFrame, labels: DataFrame, classes: list[str]) -> DataFrame:
    """Features of pages that have a label, with its number in classes as target; a label outside raises."""
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("label"))
    number = F.when(place > 0, place - 1).otherwise(F.raise_error(F.concat(F.lit("no such class: "), F.col("label"))))
    return found.join(labels.select("doc_id", "page", "label"), ["doc_id", "page"]).withColumn("target", number.cast("double")).drop("label")


def search(found: DataFrame, estimator, grid: dict[str, list], tries: int = 20, folds: int = 3, seed: int = 42, parallel: int = 2):
    """(best fitted pipeline, its micro F1, its parameters) of a seeded sample of a grid, by cross-validation; with one label a row micro F1 is accuracy."""
    options = [dict(zip(grid, v, strict=True)) for v in itertools.product(*grid.values())]
    chosen = random.Random(seed).sample(options, min(tries, len(options)))
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=feature_names(found), outputCol="features"), estimator])
    maps = [{estimator.getParam(k): v for k, v in o.items()} for o in chosen]
    check = MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy")
    fitted = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=check, numFolds=folds, seed=seed, parallelism=parallel).fit(found)
    best = max(range(len(maps)), key=lambda i: fitted.avgMetrics[i])
    return fitted.bestModel, fitted.avgMetrics[best], chosen[best]


def save(model, classes: list[str], path: str, spark) -> None:
    """The model and, beside it, the classes its targets number, so that the two cannot part."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame(list(enumerate(classes)), "target int, label string").write.mode("overwrite").parquet(f"{path}/classes")


def load(path: str, spark):
    """(model, classes) as saved; a path without them raises."""
    classes = [r.label for r in spark.read.parquet(f"{path}/classes").orderBy("target").collect()]
    return PipelineModel.load(f"{path}/model"), classes


def run_name(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d-%H%M%S")


def flat(params: dict, prefix: str = "") -> dict:
    """Nested parameters with dotted names."""
    out: dict = {}
    for k, v in params.items():
        out |= flat(v, f"{prefix}{k}.") if isinstance(v, dict) else {f"{prefix}{k}": v}
    return out


def tree_classifier(model, classes: list[str]) -> Callable[..., DataFrame]:
    """A classifier by a fitted model whose targets number classes."""

    def classify(pages: DataFrame, segs: DataFrame) -> DataFrame:
        scored = model.transform(page_features(pages, segs))
        names = F.array(*map(F.lit, classes))
        return scored.select("doc_id", "page", F.coalesce(F.get(names, F.col("prediction").cast("int")), F.lit("unknown")).alias("label"))

    return classify


def layout_classifier(predict: Callable[[DataFrame], DataFrame], classes: list[str]) -> Callable[..., DataFrame]:
    """A classifier by a layout model: predict gives logits (array of double) for samples of layout_samples(); the greatest share decides."""

    def classify(samples: DataFrame, _=None) -> DataFrame:
        names, share = F.array(*map(F.lit, classes)), softmax(F.col("logits"))
        scored = predict(samples).withColumn("score", F.array_max(share))
        return scored.select("filename", "page", F.get(names, (F.array_position("logits", F.array_max("logits")) - 1).cast("int")).alias("label"), "score")

    return classify
