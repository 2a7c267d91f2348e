"""Registered array/pixel queries over ``frames`` and, where height and width matter, ``pictures`` of
three shapes.  Wide layouts take their number of columns from the longest frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pixels as P
from ..operators import frames as FR
from ..operators import prep as PR
from ..sources import fixtures as fx
from ..sources.tables import table
from .catalog import register

N = 64  # values of the frames of the given tables, for the SQL texts of the wide layouts
_F = ("frames",)
_P = ("frames", "pictures")
N_CLASSES = 29


def _frames(spark, sf):
    return fx.frames(spark, sf)


def _duck_cols(n: int) -> str:
    return ", ".join(f"pixels[{i + 1}] AS pixel_{i}" for i in range(n))


@register("arr_from_columns", sql="""
SELECT l_orderkey, l_linenumber, [l_quantity, l_extendedprice, l_discount, l_tax] AS vals FROM lineitem""")
def arr_from_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     P.from_columns("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("vals"))


@register("arr_to_columns", fixtures=_F, sql=f"SELECT frame_id, label, {_duck_cols(N)} FROM fx_frames")
def arr_to_columns(spark, sf):
    frames = _frames(spark, sf)
    return frames.select("frame_id", "label", *P.to_columns("pixels", P.longest(frames)))


_ROWS = "list_transform(range(0, height), lambda r: pixels[r * width + 1 : r * width + width])"


@register("arr_reshape", fixtures=_P, sql=f"SELECT frame_id, {_ROWS} AS grid FROM fx_pictures")
def arr_reshape(spark, sf):
    return fx.pictures(spark, sf).select("frame_id", P.reshape("pixels", "height", "width").alias("grid"))


@register("arr_flatten", fixtures=_P, sql=f"SELECT frame_id, flatten({_ROWS}) AS flat FROM fx_pictures")
def arr_flatten(spark, sf):
    return fx.pictures(spark, sf).select("frame_id", P.flatten(P.reshape("pixels", "height", "width")).alias("flat"))


@register("arr_argmax", fixtures=_F,
          sql="SELECT frame_id, list_position(pixels, list_max(pixels)) - 1 AS argmax FROM fx_frames")
def arr_argmax(spark, sf):
    return _frames(spark, sf).select("frame_id", P.argmax("pixels").alias("argmax"))


@register("arr_crop", fixtures=_P, sql="""
SELECT frame_id, list_transform(range(height // 4, height - height // 4),
  lambda r: pixels[r * width + width // 4 + 1 : r * width + width - width // 4]) AS crop FROM fx_pictures""")
def arr_crop(spark, sf):
    """The middle of every picture: a quarter of its own height and width off each side."""
    h, w = F.col("height"), F.col("width")
    dy, dx = F.floor(h / 4).cast("int"), F.floor(w / 4).cast("int")
    return fx.pictures(spark, sf).select("frame_id", P.crop("pixels", w, dy, h - dy, dx, w - dx).alias("crop"))


@register("arr_pool_2x2", fixtures=_P, sql="""
SELECT frame_id, list_transform(range(0, (height // 2) * (width // 2)), lambda i:
  (pixels[(i // (width // 2)) * 2 * width + (i % (width // 2)) * 2 + 1] + pixels[(i // (width // 2)) * 2 * width + (i % (width // 2)) * 2 + 2]
   + pixels[((i // (width // 2)) * 2 + 1) * width + (i % (width // 2)) * 2 + 1]
   + pixels[((i // (width // 2)) * 2 + 1) * width + (i % (width // 2)) * 2 + 2])::DOUBLE / 4.0) AS pooled
FROM fx_pictures""")
def arr_pool_2x2(spark, sf):
    return fx.pictures(spark, sf).select("frame_id", P.pool_mean("pixels", "height", "width", 2).alias("pooled"))


@register("split_label_features", fixtures=_F, sql="SELECT frame_id, label, pixels AS features FROM fx_frames")
def split_label_features(spark, sf):
    frames = _frames(spark, sf)
    wide = frames.select("label", *P.to_columns("pixels", P.longest(frames)), "frame_id")
    label_col, feature_cols = wide.columns[0], wide.columns[1:-1]
    return wide.select("frame_id", F.col(label_col).alias("label"),
                       P.from_columns(*feature_cols).alias("features"))


def _duck_bilinear(h: str, w: str, oh: int, ow: int) -> str:
    """DuckDB text of the half-pixel-centre bilinear resize: the same double
    operations in the same order as the column expression, rounded half to even."""
    d = "::DOUBLE"

    def src(axis_i, n, on):
        return f"least(greatest((({axis_i} + 0.5{d}) * {n}{d}) / {on}{d} - 0.5{d}, 0{d}), ({n} - 1){d})"

    sy, sx = src("(i // %d)" % ow, h, oh), src("(i %% %d)" % ow, w, ow)
    y0, x0 = f"CAST(floor({sy}) AS BIGINT)", f"CAST(floor({sx}) AS BIGINT)"
    y1, x1 = f"least({y0} + 1, {h} - 1)", f"least({x0} + 1, {w} - 1)"
    fy, fx = f"({sy} - {y0})", f"({sx} - {x0})"

    def px(y, x):
        return f"pixels[({y}) * {w} + ({x}) + 1]{d}"

    top = f"({px(y0, x0)} * (1{d} - {fx}) + {px(y0, x1)} * {fx})"
    bot = f"({px(y1, x0)} * (1{d} - {fx}) + {px(y1, x1)} * {fx})"
    val = f"round_even({top} * (1{d} - {fy}) + {bot} * {fy}, 0)"
    return (f"list_transform(range(0, {oh * ow}), lambda i: "
            f"CAST(least(greatest({val}, 0), 255) AS INT))")


@register("arr_resize", fixtures=_P,
          sql=f"SELECT frame_id, {_duck_bilinear('height', 'width', 5, 5)} AS resized FROM fx_pictures")
def arr_resize(spark, sf):
    """Bilinear, each picture from its own height and width to 5x5."""
    return fx.pictures(spark, sf).select(
        "frame_id", P.bilinear_resize("pixels", "height", "width", 5, 5).alias("resized"))


@register("rgb_swap", fixtures=_P, sql="""
SELECT frame_id, list_transform(range(0, len(bgr)), lambda k: bgr[(k - k % 3) + 2 - k % 3 + 1]) AS rgb FROM fx_pictures""")
def rgb_swap(spark, sf):
    return fx.pictures(spark, sf).select("frame_id", P.rgb_swap("bgr").alias("rgb"))


@register("bgr_to_grey", fixtures=_P, sql="""
SELECT frame_id, list_transform(range(0, len(bgr) // 3), lambda i:
  CAST((bgr[i * 3 + 1] * 114 + bgr[i * 3 + 2] * 587 + bgr[i * 3 + 3] * 299 + 500) // 1000 AS INT)) AS grey
FROM fx_pictures""")
def bgr_to_grey(spark, sf):
    return fx.pictures(spark, sf).select("frame_id", P.bgr_to_grey("bgr").alias("grey"))


@register("pixels_scale", fixtures=_F,
          sql="SELECT frame_id, list_transform(pixels, lambda p: p / 255.0::DOUBLE) AS scaled FROM fx_frames")
def pixels_scale(spark, sf):
    return _frames(spark, sf).select("frame_id", P.scale("pixels", 255.0).alias("scaled"))


@register("pixels_clip", fixtures=_F, sql="""
SELECT frame_id, list_transform(pixels, lambda p: least(greatest(p * 2 - 128, 0), 255)) AS clipped FROM fx_frames""")
def pixels_clip(spark, sf):
    return _frames(spark, sf).select("frame_id", P.shift_and_clip("pixels", 2, -128).alias("clipped"))


@register("pixels_stretch", fixtures=_F, sql="""
SELECT frame_id, CASE WHEN list_max(pixels) > 0 THEN
  list_transform(pixels, lambda p: CAST(trunc(p * 255.0::DOUBLE / list_max(pixels)) AS INT)) ELSE pixels END AS stretched
FROM fx_frames""")
def pixels_stretch(spark, sf):
    return _frames(spark, sf).select("frame_id", P.stretch("pixels").alias("stretched"))


@register("pixels_explode", fixtures=_F, sql="""
SELECT frame_id, CAST(generate_subscripts(pixels, 1) - 1 AS INT) AS pos, unnest(pixels) AS pixel FROM fx_frames""")
def pixels_explode(spark, sf):
    return FR.explode_pixels(_frames(spark, sf))


@register("pixels_regroup", fixtures=_F, sql="SELECT frame_id AS chunk_id, pixels FROM fx_frames")
def pixels_regroup(spark, sf):
    """Flatten every frame into one pixel stream, then rebuild frames from
    chunks of consecutive positions (order restored by position)."""
    frames = _frames(spark, sf)
    n = P.longest(frames)
    flat = FR.explode_pixels(frames).select((F.col("frame_id") * n + F.col("pos")).alias("gpos"), "pixel")
    return FR.regroup(flat, n)


@register("label_one_hot", fixtures=_F, sql=f"""
SELECT frame_id, label, list_transform(range(0, {N_CLASSES}), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END) AS one_hot,
       CASE WHEN label BETWEEN 0 AND {N_CLASSES - 1} THEN label END AS decoded FROM fx_frames""")
def label_one_hot(spark, sf):
    oh = _frames(spark, sf).select("frame_id", "label", P.one_hot("label", N_CLASSES).alias("one_hot"))
    return oh.withColumn("decoded", P.argmax_decode("one_hot"))


@register("label_range", fixtures=_F,
          sql="SELECT min(label) AS min_label, max(label) AS max_label FROM fx_frames")
def label_range(spark, sf):
    return _frames(spark, sf).agg(F.min("label").alias("min_label"), F.max("label").alias("max_label"))


@register("table_shape", fixtures=_F, sql=f"SELECT count(*) AS n_rows, {N + 2} AS n_cols FROM fx_frames")
def table_shape(spark, sf):
    wide = arr_to_columns(spark, sf)
    return wide.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(wide.columns)))


@register("frame_metadata", fixtures=_P, sql="""
SELECT frame_id, CAST(to_json({'height': height, 'width': width,
                               'channels': CAST(len(bgr) // (height * width) AS INT)}) AS VARCHAR) AS metadata,
       len(bgr) AS n_values
FROM fx_pictures""")
def frame_metadata(spark, sf):
    channels = (F.size("bgr") / (F.col("height") * F.col("width"))).cast("int")
    meta = F.struct("height", "width", channels.alias("channels"))
    return fx.pictures(spark, sf).select("frame_id", F.to_json(meta).alias("metadata"),
                                         F.size("bgr").cast("bigint").alias("n_values"))


_SIDE = 28
_PLANES = f"""planes AS (SELECT stream_name, frame_id, label, height, width, ch, list_transform(range(0, height * width), lambda k: bgr[k * 3 + ch + 1]) AS pixels
  FROM fx_pictures, range(0, 3) t(ch)),
small AS (SELECT frame_id, stream_name, label, height, width, ch, {_duck_bilinear("height", "width", _SIDE, _SIDE)} AS px FROM planes),
bytes AS (SELECT b.frame_id, b.stream_name, b.label, b.height, b.width,
  list_transform(range(0, {3 * _SIDE * _SIDE}), lambda k: CASE k % 3 WHEN 0 THEN b.px[k // 3 + 1] WHEN 1 THEN g.px[k // 3 + 1] ELSE r.px[k // 3 + 1] END) AS bgr,
  list_transform(range(0, {_SIDE * _SIDE}), lambda i: CAST((b.px[i + 1] * 114 + g.px[i + 1] * 587 + r.px[i + 1] * 299 + 500) // 1000 AS INT)) AS grey
  FROM small b JOIN small g ON g.frame_id = b.frame_id JOIN small r ON r.frame_id = b.frame_id WHERE b.ch = 0 AND g.ch = 1 AND r.ch = 2)"""


def _duck_hex(px: str) -> str:
    return f"array_to_string(list_transform({px}, lambda p: printf('%02X', p)), '')"


@register("video_frames", fixtures=_P, sql=f"""WITH {_PLANES}
SELECT stream_name, CAST(row_number() OVER (PARTITION BY stream_name ORDER BY frame_id) - 1 AS INT) AS frame_number,
       CAST(to_json({{'Height': height, 'Width': width, 'Channels': 3}}) AS VARCHAR) AS metadata,
       octet_length(unhex({_duck_hex("bgr")})) AS n_bytes, md5(unhex({_duck_hex("bgr")})) AS pixel_md5, {_duck_hex("grey")} AS grey_hex FROM bytes""")
def video_frames(spark, sf):
    """Video frame records: number in the stream, size, 28x28 BGR bytes, 28x28 grey bytes (as hex)."""
    rows = PR.frame_records(fx.pictures(spark, sf), side=_SIDE)
    return rows.select("stream_name", "frame_number", "metadata", F.octet_length("pixel_data").cast("bigint").alias("n_bytes"),
                       F.md5("pixel_data").alias("pixel_md5"), F.hex("grey_data").alias("grey_hex"))


@register("pixel_bytes", fixtures=_F, sql=f"SELECT frame_id, {_duck_hex('pixels')} AS bytes, pixels FROM fx_frames")
def pixel_bytes(spark, sf):
    """Grey frames to displayable bytes and back to numbers."""
    packed = _frames(spark, sf).select("frame_id", P.ints_to_bytes("pixels").alias("data"))
    return packed.select("frame_id", F.hex("data").alias("bytes"), P.bytes_to_ints("data").alias("pixels"))
