"""A linear frame scorer with fixed, documented weights.

Class ``k`` scores the sum over the pixels of ``pixel[i] * weight(k, i)``, where
``weight(k, i) = (i * (2k + 1) + 7k) % 23 - 11``; the prediction is the smallest class with the
highest score.  All numbers are integers, so every engine gives the same result and the flows
around a model (batch, transcript, stream) can be checked in SQL.  The flows take any
``PipelineModel``; fitted ones are in ``operators.ml``.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pixels import let

CLASSES = 29
PERIOD = 23  # of the weights, along the pixels


def linear_class(px: Column, classes: int = CLASSES) -> Column:
    """Predicted class of a pixel array of any length, in the JVM; null pixels give null."""
    def residue_sum(values: Column, j: Column) -> Column:
        n = F.size(values)
        return F.when(j < n, F.aggregate(F.sequence(j, n - 1, F.lit(PERIOD)), F.lit(0).cast("long"),
                                         lambda a, i: a + F.get(values, i).cast("long"))).otherwise(F.lit(0).cast("long"))

    def score(sums: Column, k: Column) -> Column:
        terms = F.transform(sums, lambda s, j: s * ((j * (2 * k + 1) + 7 * k) % PERIOD - 11))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda a, x: a + x)

    # the pixels and the scores are bound once; named inside a lambda they would be worked out per class
    # a pixel's weights depend on its place modulo PERIOD only, so pixels of one residue are summed first
    sums = let(px, lambda values: F.when(values.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(PERIOD - 1)), lambda j: residue_sum(values, j))))
    scores = let(sums, lambda s: F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: score(s, k)))
    return let(scores, lambda s: F.array_position(s, F.array_max(s)) - 1).cast("int")


class LinearScorer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: ``prediction`` by :func:`linear_class`; batch and stream frames alike."""

    classes = Param(Params._dummy(), "classes", "number of classes", typeConverter=TypeConverters.toInt)

    def __init__(self, inputCol: str = "pixels", outputCol: str = "prediction", classes: int = CLASSES):
        super().__init__()
        self._setDefault(classes=CLASSES)
        self._set(inputCol=inputCol, outputCol=outputCol, classes=classes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(),
                                  linear_class(F.col(self.getInputCol()), self.getOrDefault(self.classes)))


def linear_model() -> PipelineModel:
    return PipelineModel(stages=[LinearScorer()])


def served_udf(n_pixels: int, classes: int = CLASSES, batch_size: int = 1024):
    """The same weights as an outside numpy model behind ``predict_batch_udf``: one build per
    worker, Arrow batches in.  A served model has a fixed input size, ``n_pixels``."""
    def make_predict_fn():
        k, i = np.arange(classes)[:, None], np.arange(n_pixels)[None, :]
        weights = ((i * (2 * k + 1) + 7 * k) % 23 - 11).astype(np.float64)

        def predict(x: np.ndarray) -> np.ndarray:
            return (x.reshape(-1, n_pixels) @ weights.T).argmax(axis=1).astype(np.int32)
        return predict

    return predict_batch_udf(make_predict_fn, return_type=T.IntegerType(), batch_size=batch_size,
                             input_tensor_shapes=[[n_pixels]])
