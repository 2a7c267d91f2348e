"""Spark ML models over frames: features, pipelines, scoring, persistence.

* The /255 scaling is a pipeline stage, so the saved ``PipelineModel``
  applies the same preprocessing at serving time as at training time.
* Splits are keyed (md5 of the frame id), so they are stable across runs.
* The checkable fixed-weight scorer and the served model are in
  ``operators.scoring``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import keyed_bucket

N_QUARTERS = 4


def quarter_target(px="pixels") -> Column:
    """Learnable class of a frame: which quarter of its values has the largest sum (0..3; the last
    quarter takes the remainder, the first of equal sums wins)."""
    arr = F.col(px) if isinstance(px, str) else px
    n = F.size(arr)
    q = F.floor(n / N_QUARTERS).cast("int")

    def total(i: int) -> Column:
        length = n - q * (N_QUARTERS - 1) if i == N_QUARTERS - 1 else q
        return F.aggregate(F.slice(arr, q * i + 1, length), F.lit(0).cast("long"), lambda acc, v: acc + v)

    sums = F.array(*[total(i) for i in range(N_QUARTERS)])
    return (F.array_position(sums, F.array_max(sums)) - 1).cast("int")


def training_frames(frames: DataFrame, train_pct: int = 75) -> DataFrame:
    return frames.select("frame_id", "pixels", quarter_target("pixels").cast("double").alias("target"),
                         (keyed_bucket("frame_id") < train_pct).alias("is_train"))


class PixelScaler(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                  DefaultParamsWritable):
    """Pipeline stage: ``features = vector(pixels / divisor)``, a JVM column
    expression (no Python per row); saved and loaded with the pipeline."""

    divisor = Param(Params._dummy(), "divisor", "value that maps to 1.0",
                    typeConverter=TypeConverters.toFloat)

    def __init__(self, inputCol: str = "pixels", outputCol: str = "features", divisor: float = 255.0):
        super().__init__()
        self._setDefault(divisor=255.0)
        self._set(inputCol=inputCol, outputCol=outputCol, divisor=divisor)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d = float(self.getOrDefault(self.divisor))
        scaled = F.transform(F.col(self.getInputCol()), lambda p: p.cast("double") / d)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(scaled))


def wide_features(columns: list[str], output_col: str = "features", divisor: float = 255.0):
    """Pipeline stages for the wide CSV layout (``pixel1 … pixelN`` columns):
    ``VectorAssembler`` then a scale by ``divisor`` (kept inside the model)."""
    assemble = VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="keep")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([1.0 / divisor] * len(columns)),
                               inputCol="_raw", outputCol=output_col)
    return [assemble, scale]


def scaled_features(input_col: str = "pixels", output_col: str = "features") -> PixelScaler:
    return PixelScaler(inputCol=input_col, outputCol=output_col)


def random_forest(seed: int = 42, label_col: str = "target") -> Pipeline:
    """Defaults of the application: 20 trees, depth 5."""
    rf = RandomForestClassifier(labelCol=label_col, featuresCol="features", seed=seed)
    return Pipeline(stages=[scaled_features(), rf])


def mlp(layers=(64, 64, 64, N_QUARTERS), max_iter: int = 95, seed: int = 42,
        label_col: str = "target") -> Pipeline:
    m = MultilayerPerceptronClassifier(labelCol=label_col, featuresCol="features",
                                       layers=list(layers), maxIter=max_iter, seed=seed)
    return Pipeline(stages=[scaled_features(), m])


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on a persisted copy of the training rows (iterative learners read
    them many times); the copy is released afterwards."""
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def scored(model: PipelineModel, frames: DataFrame, keep=("frame_id", "target")) -> DataFrame:
    out = model.transform(frames)
    return out.select(*[c for c in keep if c in out.columns],
                      F.col("prediction").cast("int").alias("prediction"))


def evaluate_accuracy(predictions: DataFrame, label_col: str = "target") -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction",
                                           metricName="accuracy")
    return ev.evaluate(predictions.withColumn("prediction", F.col("prediction").cast("double")))


def label_indexer(input_col: str, output_col: str) -> StringIndexer:
    """Most frequent value -> 0; ties alphabetical."""
    return StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType="frequencyDesc")


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
