"""Registered source/sink queries.  Each writes data Spark derives from the
tables into a fresh folder below the shared checkpoint folder and reads it
back through the source under test."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pixels as P
from ..operators import dataset as D
from ..operators import labels as L
from ..operators import ml as M
from ..schemas import LABELS_DIM, label_rows, wide_schema
from ..session import fresh_path
from ..sources import files as IO
from ..sources import fixtures as fx
from ..sources import images as IMG
from ..sources.tables import table
from .catalog import register

_PRED_SCHEMA = T.StructType([T.StructField("sample_id", T.LongType()),
                             T.StructField("actual", T.IntegerType()),
                             T.StructField("predicted", T.IntegerType())])
_LABELLED = """
SELECT n.file_id, coalesce(d.label_id, 27) AS label_id
FROM fx_image_names n LEFT JOIN fx_labels_dim d
  ON d.label_name = split_part(split_part(string_split(n.path, '/')[-1], '.', 1), '_', 1)
"""


@register("src_csv_typed", fixtures=("pred",), sql="SELECT sample_id, actual, predicted FROM fx_pred")
def src_csv_typed(spark, sf):
    path = IO.write_csv(fx.pred(spark, sf), fresh_path(spark, "csv-typed"))
    return IO.read_csv_typed(spark, path, _PRED_SCHEMA)


@register("src_csv_strings", fixtures=("sl_users",), sql="""
SELECT sha_name, total_responses, nullif(yes_txt, '') AS yes_txt, nullif(no_txt, '') AS no_txt FROM fx_sl_users""")
def src_csv_strings(spark, sf):
    """All-string read; as in any default CSV read, a blank cell comes back null."""
    path = IO.write_csv(fx.sl_users(spark, sf), fresh_path(spark, "csv-strings"))
    return IO.read_csv_strings(spark, path)


@register("src_csv_inferred", fixtures=("frames",), sql=f"""
SELECT CAST(frame_id AS INT) AS frame_id, label, {", ".join(f"pixels[{i + 1}] AS pixel_{i}" for i in range(64))}
FROM fx_frames""")
def src_csv_inferred(spark, sf):
    frames = fx.frames(spark, sf)
    wide = frames.select("frame_id", "label", *P.to_columns("pixels", P.longest(frames)))
    path = IO.write_csv(wide, fresh_path(spark, "csv-inferred"))
    return IO.read_csv_inferred(spark, path)


@register("src_csv_headerless", fixtures=("frames",), sql=f"""
SELECT label, {", ".join(f"pixels[{i}] AS pixel{i}" for i in range(1, 65))}, frame_id FROM fx_frames""")
def src_csv_headerless(spark, sf):
    """Training CSV without a header: ``label, pixel1 …, frame_id``."""
    fr = fx.frames(spark, sf)
    n = P.longest(fr)
    wide = fr.select("label", *P.to_columns("pixels", n, prefix="c"), "frame_id")
    path = IO.write_csv(wide, fresh_path(spark, "csv-headerless"), header=False)
    names = ["label"] + [f"pixel{i}" for i in range(1, n + 1)] + ["frame_id"]
    types = [T.IntegerType()] * (n + 1) + [T.LongType()]
    return IO.read_csv_headerless(spark, path, names, types)


@register("src_local_rows", fixtures=("image_names", "labels_dim"), sql=f"""
SELECT d.label_id, d.label_name, d.glyph, count(t.file_id) AS n
FROM fx_labels_dim d LEFT JOIN ({_LABELLED}) t ON t.label_id = d.label_id
GROUP BY d.label_id, d.label_name, d.glyph""")
def src_local_rows(spark, sf):
    """The class list built from driver-side rows (29, fixed) with the number
    of training files per class counted on the cluster."""
    dim = spark.createDataFrame(label_rows(), LABELS_DIM)
    counts = L.class_balance(L.with_label(fx.image_names(spark, sf), dim))
    return dim.join(counts, "label_id", "left").na.fill(0, ["n"])


@register("sink_csv_roundtrip", fixtures=("frames",), sql=f"""
SELECT label, {", ".join(f"pixels[{i + 1}] AS pixel_{i}" for i in range(64))} FROM fx_frames""")
def sink_csv_roundtrip(spark, sf):
    """Dataset CSV: header ``label, pixel_0 …``, overwrite, read back typed."""
    frames = fx.frames(spark, sf)
    n = P.longest(frames)
    path = IO.write_csv(frames.select("label", *P.to_columns("pixels", n)), fresh_path(spark, "dataset-csv"))
    return IO.read_csv_typed(spark, path, wide_schema("label", n, prefix="pixel_"))


@register("sink_parquet_roundtrip", fixtures=("frames",),
          sql="SELECT frame_id, stream_name, label, pixels FROM fx_frames")
def sink_parquet_roundtrip(spark, sf):
    fr = fx.frames(spark, sf).select("frame_id", "stream_name", "label", "pixels")
    path = IO.write_parquet(fr, fresh_path(spark, "bursts"), partition_by=["stream_name"])
    return spark.read.parquet(path).select("frame_id", "stream_name", "label", "pixels")


def _png_folder(spark, sf):
    """Every frame as a colour picture file of its own height and width."""
    root = fresh_path(spark, "png")
    rgb = fx.pictures(spark, sf).select("frame_id", "height", "width", P.rgb_swap("bgr").alias("pixels"))
    IMG.write_pngs(rgb, root, "height", "width", channels=3).write.format("noop").mode("overwrite").save()
    return root


@register("src_binary_files", fixtures=("frames", "pictures"), sql="""
SELECT frame_id, height, width, true AS whole FROM fx_pictures""")
def src_binary_files(spark, sf):
    """Whole-file scan of the pictures: size from the bytes of each header, and whether the content
    is as long as the file and closes with its end mark."""
    files = IO.read_binary_files(spark, _png_folder(spark, sf), "*.png")

    def number(at: int):  # big-endian, four bytes from byte ``at``
        return F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")

    ends = F.hex(F.substring("content", -8, 4)) == F.hex(F.lit("IEND"))
    return files.select(IMG.frame_key_from_path("path").alias("frame_id"), number(21).alias("height"),
                        number(17).alias("width"),
                        ((F.octet_length("content") == F.col("length")) & ends).alias("whole"))


@register("src_image_decode", fixtures=("frames", "pictures"), sql="""
SELECT frame_id, height, width, 3 AS channels, bgr AS pixels FROM fx_pictures""")
def src_image_decode(spark, sf):
    imgs = IO.image_pixels(IO.read_images(spark, _png_folder(spark, sf)))
    return imgs.select(IMG.frame_key_from_path("origin").alias("frame_id"),
                       "height", "width", "channels", "pixels")


@register("src_text_lines", sql="""
SELECT CAST(doc_id AS VARCHAR) || ':' || lang AS line, 2 AS n FROM documents""")
def src_text_lines(spark, sf):
    """Text lines appended twice to a folder of line files, read back and counted."""
    lines = table(spark, sf, "documents").select(F.concat_ws(":", "doc_id", "lang").alias("line"))
    path = fresh_path(spark, "lines")
    for _ in range(2):
        IO.append_lines(lines, path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).cast("int").alias("n"))


@register("src_survey_csv", fixtures=("survey",), sql="""
SELECT GEO, REF_DATE, round(avg(VALUE), 6) AS avg_value, count(*) AS n FROM fx_survey GROUP BY ALL""")
def src_survey_csv(spark, sf):
    """The survey through its own source: CSV with inferred types, VALUE cast to a float number."""
    facts = fx.survey(spark, sf, ("REF_DATE", "GEO", "VALUE"))
    back = IO.read_csv_inferred(spark, IO.write_csv(facts, fresh_path(spark, "survey-csv")))
    return back.groupBy("GEO", "REF_DATE").agg(F.round(F.avg(F.col("VALUE").cast("double")), 6).alias("avg_value"),
                                               F.count(F.lit(1)).alias("n"))


@register("src_csv_row_arrays", fixtures=("frames",), sql="""
SELECT CAST(pixels AS DOUBLE[]) AS "values", count(*) AS n FROM fx_frames GROUP BY ALL""")
def src_csv_row_arrays(spark, sf):
    """Lines of bare numbers, one picture a line, back as arrays."""
    lines = fx.frames(spark, sf).select(F.array_join(F.col("pixels").cast("array<string>"), ",").alias("line"))
    back = IO.read_csv_rows_as_arrays(spark, IO.append_lines(lines, fresh_path(spark, "csv-rows")))
    return back.groupBy("values").agg(F.count(F.lit(1)).alias("n"))


@register("src_csv_pixel_column", fixtures=("frames",), sql="""
SELECT stream_name, row_number() OVER (PARTITION BY stream_name ORDER BY frame_id) - 1 AS picture, pixels FROM fx_frames""")
def src_csv_pixel_column(spark, sf):
    """One column of pixels per stream, written in frame order, back to pictures by position."""
    frames = fx.frames(spark, sf)
    n, root = P.longest(frames), fresh_path(spark, "csv-column")
    flat = frames.select("stream_name", "frame_id", F.posexplode("pixels").alias("pos", "Pixel"))
    ordered = flat.repartition("stream_name").sortWithinPartitions("stream_name", "frame_id", "pos")
    ordered.select("stream_name", "Pixel").write.partitionBy("stream_name").option("header", True).csv(root)
    back = IO.read_csv_column(spark, root, "Pixel", "INT")
    picture = F.floor(F.col("position") / n).cast("long").alias("picture")
    rows = back.groupBy("path", picture).agg(F.array_sort(F.collect_list(F.struct("position", "Pixel"))).alias("_s"))
    return rows.select(F.regexp_extract("path", "stream_name=([^/]+)/", 1).alias("stream_name"), "picture",
                       F.transform("_s", lambda s: s["Pixel"]).alias("pixels"))


@register("src_csv_pair", fixtures=("frames",), sql="""
SELECT frame_id, CASE WHEN ('0x' || substr(md5(CAST(frame_id AS VARCHAR)), 1, 8))::UBIGINT % 100 < 75 THEN 'train' ELSE 'test' END AS part,
       CASE WHEN label > 9 THEN label - 1 ELSE label END AS label, len(pixels) AS n_features,
       round(list_sum(list_transform(pixels, lambda p: p / 255.0::DOUBLE)), 6) AS feature_sum FROM fx_frames""")
def src_csv_pair(spark, sf):
    """The train and test CSV pair: wide files read with their schema, label gap closed, pixel columns
    assembled to a scaled vector."""
    frames = fx.frames(spark, sf)
    n = P.longest(frames)
    wide = D.keyed_split(frames.select("frame_id", "label", *P.to_columns("pixels", n, prefix="pixel")), "frame_id", 75)
    schema = T.StructType([T.StructField("frame_id", T.LongType()), *wide_schema("label", n).fields])
    parts = []
    for part, side in (("train", F.col("is_train")), ("test", ~F.col("is_train"))):
        path = IO.write_csv(wide.where(side).drop("is_train"), fresh_path(spark, part))
        parts.append(IO.read_csv_typed(spark, path, schema).withColumn("part", F.lit(part)))
    rows = parts[0].unionByName(parts[1]).withColumn("label", L.close_gap("label"))
    assembled = Pipeline(stages=M.wide_features([f"pixel{i}" for i in range(n)])).fit(rows).transform(rows)
    values = vector_to_array("features")
    return assembled.select("frame_id", "part", "label", F.size(values).cast("bigint").alias("n_features"),
                            F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6).alias("feature_sum"))
