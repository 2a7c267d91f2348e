"""Model-quality metrics over ``(actual, predicted)`` pairs.

Each pair is expanded once into its two class contributions (actual side and
predicted side) and aggregated per class with map-side partial aggregation;
the per-class table has one row per class, so the averages on top of it are
tiny.  No pair list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_counts(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Per class: tp, pp (predicted positives), ap (actual positives = support)."""
    a, p = F.col(actual), F.col(predicted)
    sides = F.array(
        F.struct(a.alias("cls"), F.lit(1).alias("ap"), F.lit(0).alias("pp"),
                 (a == p).cast("int").alias("tp")),
        F.struct(p.alias("cls"), F.lit(0).alias("ap"), F.lit(1).alias("pp"), F.lit(0).alias("tp")))
    x = pred.select(F.inline(sides))
    return x.groupBy("cls").agg(F.sum("tp").cast("double").alias("tp"),
                                F.sum("pp").cast("double").alias("pp"),
                                F.sum("ap").cast("double").alias("ap"))


def _ratios(k: DataFrame) -> DataFrame:
    tp, pp, ap = F.col("tp"), F.col("pp"), F.col("ap")
    zero = F.lit(0.0)
    return k.select(
        "cls", "tp", "ap",
        F.coalesce(F.try_divide(tp, F.nullif(pp, zero)), zero).alias("p"),
        F.coalesce(F.try_divide(tp, F.nullif(ap, zero)), zero).alias("r"),
        F.coalesce(F.try_divide(tp * 2, F.nullif(pp + ap, zero)), zero).alias("f"))


def report(pred: DataFrame, **kw) -> DataFrame:
    """Precision, recall, F1 and support per class (0 when undefined)."""
    r = _ratios(class_counts(pred, **kw))
    return r.select("cls", F.round("p", 6).alias("prec"), F.round("r", 6).alias("rec"),
                    F.round("f", 6).alias("f1"), F.col("ap").cast("long").alias("support"))


def summary(pred: DataFrame, **kw) -> DataFrame:
    """Accuracy, macro and support-weighted averages of the report."""
    r = _ratios(class_counts(pred, **kw))
    sap = F.sum("ap")
    return r.agg(
        F.round(F.sum("tp") / sap, 6).alias("accuracy"),
        F.round(F.avg("p"), 6).alias("macro_p"), F.round(F.avg("r"), 6).alias("macro_r"),
        F.round(F.avg("f"), 6).alias("macro_f1"),
        F.round(F.sum(F.col("p") * F.col("ap")) / sap, 6).alias("weighted_p"),
        F.round(F.sum(F.col("r") * F.col("ap")) / sap, 6).alias("weighted_r"),
        F.round(F.sum(F.col("f") * F.col("ap")) / sap, 6).alias("weighted_f1"))


def accuracy(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    hit = (F.col(actual) == F.col(predicted)).cast("int")
    return pred.agg(F.round(F.avg(hit), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion(pred: DataFrame, classes: list[int], actual: str = "actual",
              predicted: str = "predicted", prefix: str = "p_") -> DataFrame:
    """Rows: every class seen as actual or predicted; columns: ``classes``
    (the model's declared output classes) and ``{prefix}other`` (any other
    prediction, null included); zero-filled counts that add up to all pairs.

    One scan: each pair adds 1 at (actual, predicted) and a zero-weight
    marker on its predicted class, so classes only ever predicted still get
    a row; one partial/final pivoting aggregate does the rest."""
    a, p = F.col(actual), F.col(predicted)
    other = min(classes) - 1
    sides = F.array(
        F.struct(a.alias("actual"), F.when(p.isin(classes), p).otherwise(F.lit(other)).alias("_col"), F.lit(1).alias("_w")),
        F.struct(p.alias("actual"), F.lit(None).cast(pred.schema[predicted].dataType).alias("_col"),
                 F.lit(0).alias("_w")))
    counts = (pred.select(F.inline(sides))
                  .groupBy("actual").pivot("_col", [*classes, other]).agg(F.sum("_w")))
    names = {**{c: f"{prefix}{c}" for c in classes}, other: f"{prefix}other"}
    return counts.select("actual", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(name)
                                     for c, name in names.items()])
