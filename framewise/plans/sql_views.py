"""The derived inputs as temp views, for users who write ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources import fixtures as fx

VIEWS = {
    "survey": fx.survey,
    "sl_users": fx.sl_users,
    "frames": fx.frames,
    "landmarks": fx.landmarks,
}

def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register every derived input as a temp view (lazy: nothing runs)."""
    for name, build in VIEWS.items():
        build(spark, sf_dir).createOrReplaceTempView(name)
    return list(VIEWS)
