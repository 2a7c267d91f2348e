"""Derived inputs of the application, built from the base tables.

``survey``      hearing-survey facts (one row per line item)
``sl_users``    sign-language survey, all strings, with blanks
``landmarks``   hand points per frame on a 640x480 picture
``frames``      8x8 grey frames, five per second, four streams
``pictures``    the frames in three shapes, grey and as interleaved BGR
``pred``        (actual, predicted) pairs of a ten-class model
``image_names`` training file paths with label tokens
``labels_dim``  the 29-class dictionary

All are lazy DataFrames; the joins are plain equi-joins so the optimizer picks
the strategy at run time (AQE).  Only ``nation`` (25 rows, fixed by the TPC-H
definition) and ``labels_dim`` (29 rows) are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ntz_from_micros
from ..schemas import LABELS_DIM, label_rows
from .tables import table

FRAME_W, FRAME_H = 640, 480
EPOCH_2024_US = 1704067200000000
FRAME_PERIOD_US = 200000


SURVEY_LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                        "l_returnflag", "l_linestatus")
SURVEY_ORDERS_COLS = ("o_orderkey", "o_orderdate")


SURVEY_COLUMNS = ("REF_DATE", "GEO", "Age_group", "Sex", "Categories", "Characteristics", "VALUE")


def survey(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = SURVEY_COLUMNS,
           hearing_loss: bool = False) -> DataFrame:
    """The survey facts; only the dimensions that ``columns`` need are joined (every line item has
    its order, part and supplier, so the rows are the same).  ``hearing_loss`` keeps that category,
    as a filter of the line item scan."""
    li = table(spark, sf_dir, "lineitem").select(*SURVEY_LINEITEM_COLS)
    if hearing_loss:
        li = li.where(F.col("l_returnflag") == "R")
    orders = table(spark, sf_dir, "orders").select(*SURVEY_ORDERS_COLS)
    return survey_from(spark, sf_dir, li, orders, columns)


def survey_from(spark: SparkSession, sf_dir: str, li: DataFrame, orders: DataFrame,
                columns: tuple[str, ...] = SURVEY_COLUMNS) -> DataFrame:
    """The survey facts from given lineitem/orders inputs (plain scans, or
    the bucketed copies of ``sources.staging``) and the dimension tables."""
    j = li
    if "REF_DATE" in columns:
        j = j.join(orders, li.l_orderkey == orders.o_orderkey)
    if "Age_group" in columns:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
        j = j.join(part, li.l_partkey == part.p_partkey)
    if "GEO" in columns:
        supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        supp_nation = supp.join(F.broadcast(nation), supp.s_nationkey == nation.n_nationkey)
        j = j.join(supp_nation, li.l_suppkey == supp_nation.s_suppkey)
    size = F.col("p_size")
    age = (F.when(size <= 5, "Ages 6 to 79").when(size <= 14, "Ages 6 to 11")
           .when(size <= 23, "Ages 12 to 19").when(size <= 32, "Ages 20 to 39")
           .when(size <= 41, "Ages 40 to 59").otherwise("Ages 60 to 79"))
    ln3 = F.col("l_linenumber") % 3
    characteristic = (F.when(ln3 == 0, "Low 95% confidence interval")
                      .when(ln3 == 1, "High 95% confidence interval").otherwise("Estimate"))
    facts = {
        "REF_DATE": F.year("o_orderdate").cast("int"),
        "GEO": F.col("n_name"),
        "Age_group": age,
        "Sex": F.when(F.col("l_linestatus") == "F", "Females").otherwise("Males"),
        "Categories": F.when(F.col("l_returnflag") == "R", "Hearing loss").otherwise("Other"),
        "Characteristics": characteristic,
        "VALUE": F.when(F.col("l_quantity") == 13, F.lit(None)).otherwise(F.col("l_quantity")).cast("double"),
    }
    return j.select(*[facts[c].alias(c) for c in columns])


def sl_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
    blank = F.col("c_custkey") % 97 == 0
    rich = F.col("c_acctbal") > 4000
    return j.select(
        F.col("n_name").alias("sha_name"),
        (F.col("c_custkey") % 7 + 1).cast("string").alias("total_responses"),
        F.when(blank, "").when(rich, "1").otherwise("0").alias("yes_txt"),
        F.when(blank, "").when(rich, "0").otherwise("1").alias("no_txt"),
    )


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """21 points per hand; a second hand when vec_id % 3 = 0; none when % 10 = 9."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    vid = F.col("vec_id")
    positions = F.when(vid % 3 == 0, F.sequence(F.lit(0), F.lit(31))) \
                 .otherwise(F.sequence(F.lit(0), F.lit(20)))
    pts = emb.where(vid % 10 != 9).select("vec_id", "embedding", F.explode(positions).alias("pos"))
    pos = F.col("pos")
    ex = F.get(F.col("embedding"), pos * 2).cast("double")
    ey = F.get(F.col("embedding"), pos * 2 + 1).cast("double")
    return pts.select(
        vid.alias("frame_id"),
        F.when(pos < 21, 0).otherwise(1).alias("hand_id"),
        pos.cast("int").alias("pos"),
        (((vid % 5) * 0.2 + 0.1 + ex * 0.2) * FRAME_W).cast("int").alias("x"),
        ((ey * 0.2 + 0.5) * FRAME_H).cast("int").alias("y"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    vid = F.col("vec_id")
    pixels = F.transform(
        "embedding",
        lambda e: (F.least(F.greatest((e.cast("double") + 0.6) / 1.2, F.lit(0.0)), F.lit(1.0))
                   * 255).cast("int"))
    return emb.select(
        vid.alias("frame_id"),
        F.concat(F.lit("s"), (F.expr("vec_id div 5") % 4).cast("string")).alias("stream_name"),
        ntz_from_micros(F.lit(EPOCH_2024_US) + vid * FRAME_PERIOD_US).alias("ts"),
        F.col("label"),
        pixels.alias("pixels"),
    )


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame as an 8 x 8, 4 x 16 or 16 x 4 picture: ``pixels`` (grey) and ``bgr`` (three values
    a pixel, all derived from the frame's 64)."""
    kind = F.col("frame_id") % 3
    bgr = F.transform(F.sequence(F.lit(0), F.size("pixels") * 3 - 1),
                      lambda k: (F.get("pixels", (k / 3).cast("int")) * (k % 3 + 1) + k % 3 * 37) % 256)
    return frames(spark, sf_dir).select(
        "frame_id", "stream_name", "ts", "label", F.when(kind == 0, 8).when(kind == 1, 4).otherwise(16).alias("height"),
        F.when(kind == 0, 8).when(kind == 1, 16).otherwise(4).alias("width"), "pixels", bgr.alias("bgr"))


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    vid = F.col("vec_id")
    return emb.select(
        vid.alias("sample_id"),
        F.col("label").alias("actual"),
        F.when(vid % 3 == 0, ((vid * 7 + F.col("label")) % 10).cast("int"))
         .otherwise(F.col("label")).alias("predicted"),
    )


def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id")
    k = F.col("event_id") % 31
    token = (F.when(k == 26, "del").when(k == 27, "nothing").when(k == 28, "space")
             .when(k == 29, "junk").when(k == 30, "A7")
             .otherwise(F.char((k + 65).cast("int"))))
    return ev.select(
        F.col("event_id").alias("file_id"),
        F.concat(F.lit("/data/train/"), token, F.lit("_"),
                 F.col("event_id").cast("string"), F.lit(".v1.jpg")).alias("path"),
    )


def labels_dim(spark: SparkSession) -> DataFrame:
    """29 rows — small by definition, safe to broadcast."""
    return spark.createDataFrame(label_rows(), LABELS_DIM)
