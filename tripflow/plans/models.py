"""Random forests on the feature tables and batch scoring with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, functions as F

from tripflow.settings import MODEL_FEATURES

SEED = 42
TREES = 200


@dataclass(frozen=True)
class ModelSpec:
    target: str
    key: tuple[str, ...]
    classifier: bool

    @property
    def metric(self) -> str:
        return "auc" if self.classifier else "mae"


MODELS = {
    "demand_model": ModelSpec("completed_trips", ("event_date", "city_id"), False),
    "surge_model": ModelSpec("avg_surge_multiplier", ("event_date", "city_id"), False),
    "fraud_model": ModelSpec("is_high_risk", ("fraud_fact_key",), True),
    "churn_model": ModelSpec("churned_7d", ("rider_key", "activity_date"), True),
}


def in_test_share(*key: str, parts: int = 5) -> Column:
    """True for about one key in ``parts``, the same keys on every run and any partitioning."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    digits = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % parts == 0


def split(frame: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, 80 to 20."""
    return frame.filter(~in_test_share(*key)), frame.filter(in_test_share(*key))


def feature_inputs(frame: DataFrame, name: str) -> list[Column]:
    """Features as doubles in the model's order; missing ones are zero."""
    return [
        (
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in frame.columns else F.lit(0.0)
        ).alias(c)
        for c in MODEL_FEATURES[name]
    ]


def _estimator(name: str, spec: ModelSpec, trees: int, depth: int) -> Pipeline:
    forest = RandomForestClassifier if spec.classifier else RandomForestRegressor
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=MODEL_FEATURES[name], outputCol="features"),
            forest(
                featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED,
                maxMemoryInMB=1024,
            ),
        ]
    )


def _why_not(found: Row, spec: ModelSpec) -> str | None:
    """Why a model cannot be trained on these rows, or None. Skipping counts as success."""
    if not found["rows"]:
        return "no training data"
    if spec.classifier and found["least"] == found["most"]:
        return "insufficient class diversity"
    return None


def train(
    frame: DataFrame, name: str, trees: int = TREES, depth: int = 5
) -> tuple[PipelineModel | None, dict]:
    """Fit on the train share, measure on the test share.

    The outcome counts rows of both shares and positive labels; the metric is in its band if an AUC
    lies between 0 and 1, or a mean error between 0 and the range of the labels.
    """
    spec = MODELS[name]
    rows = frame.filter(F.col(spec.target).isNotNull()).select(
        *feature_inputs(frame, name),
        F.col(spec.target).cast("double").alias("label"),
        in_test_share(*spec.key).alias("_test"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The features feed several passes; a lost block is computed again from the tables.
        found = rows.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_test").alias("test_rows"),
            F.count_if(F.col("label") > 0).alias("positive_rows"),
            F.min("label").alias("least"),
            F.max("label").alias("most"),
        ).first()
        outcome = {
            "model_name": name, "status": "success", "train_rows": found["rows"] - found["test_rows"],
            "test_rows": found["test_rows"], "positive_rows": found["positive_rows"],
        }
        note = _why_not(found, spec)
        if note:
            return None, outcome | {"note": note}
        model = _estimator(name, spec, trees, depth).fit(rows.filter(~F.col("_test")))
        scored = model.transform(rows.filter("_test"))
        if spec.classifier:
            value = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored)
        else:
            value = RegressionEvaluator(metricName="mae").evaluate(scored)
    finally:
        rows.unpersist()
    most = 1.0 if spec.classifier else found["most"] - found["least"]
    return model, outcome | {
        "metric_name": spec.metric, "metric_value": value, "metric_in_band": 0 <= value <= most,
    }


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, frame: DataFrame, name: str) -> DataFrame:
    """The frame's rows with ``prediction``; classifiers add ``probability`` of class one."""
    spec = MODELS[name]
    wide = frame.withColumn("_row", F.struct(*frame.columns))
    scored = model.transform(wide.select("_row", *feature_inputs(frame, name)))
    if not spec.classifier:
        return scored.select("_row.*", "prediction")
    chance = vector_to_array("probability").getItem(1)
    return scored.select("_row.*", chance.alias("probability")).withColumn(
        "prediction", F.when(F.col("probability") >= 0.5, 1).otherwise(0)
    )
