"""Co-located copies of the two largest survey inputs.

``lineitem`` and ``orders`` are written once, bucketed and sorted by order
key, as external tables below the shared folder (Spark's own catalog; no
metastore service).  A join of the two on the order key then reads matching
buckets side by side: the largest shuffle of every survey query disappears,
which pays off as soon as the survey is queried more than once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path
from . import fixtures as fx
from .tables import table


def stage_survey_inputs(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> dict[str, str]:
    """Write the bucketed copies; returns the table names to read them by."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex[:8]
    names = {"lineitem": f"fw_lineitem_{tag}", "orders": f"fw_orders_{tag}"}
    li = table(spark, sf_dir, "lineitem").select(*fx.SURVEY_LINEITEM_COLS)
    orders = table(spark, sf_dir, "orders").select(*fx.SURVEY_ORDERS_COLS)
    for df, key, name in ((li, "l_orderkey", names["lineitem"]), (orders, "o_orderkey", names["orders"])):
        (df.write.bucketBy(n, key).sortBy(key)
           .option("path", fresh_path(spark, name)).mode("overwrite").saveAsTable(name))
    return names


def staged_survey(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> DataFrame:
    """The survey facts over the bucketed copies (same rows as ``fixtures.survey``)."""
    return fx.survey_from(spark, sf_dir, spark.table(names["lineitem"]), spark.table(names["orders"]))
