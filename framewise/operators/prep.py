"""Frame preparation flows, composed from the geometry and pixel operators.

``picture_crops`` landmarks -> centre/reach -> square box -> crop -> bilinear
                 resize -> grey, on decoded colour pictures of any size
                 (the batch conversion flow)
``hand_crops``    the same boxes on square grey frames, nearest resize
``training_rows`` colour picture -> grey -> resize -> label (no hand search)

The hand flow has four exchanges: the landmarks of a frame are brought
together (see ``operators.geometry``), and the frames (with their pixels) meet
their boxes in one join on ``frame_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixels as P
from ..session import fresh_path
from . import geometry as G
from .ranking import ranked

OUT = 4  # prepared frames are OUT x OUT


def _grid(v, scale, size: int):
    """Picture coordinate -> frame-grid index (floor)."""
    return F.floor(v * scale / size).cast("int")


def hand_crops(frames: DataFrame, landmarks: DataFrame, width: int = G.FRAME_W, height: int = G.FRAME_H,
               tee: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(frame_id, pixels, is_reject)``: the square hand box of each square grey frame, mapped onto the
    frame's own grid and resampled to OUT x OUT (nearest).  A frame whose number of values is no square
    is flagged, with null pixels.  ``keep`` carries further frame columns through the same join.

    With ``tee`` the intermediate stage rows (centre and reach, box, crop) are also written as Parquet
    under that folder for inspection."""
    boxes = G.boxes_for_frames(frames, landmarks, keep=("pixels", *keep))
    side = F.rint(F.sqrt(F.size("pixels").cast("double"))).cast("int")
    sized = boxes.withColumn("side", side).withColumn("whole", F.coalesce((F.size("pixels") > 0) & (F.col("side") * F.col("side") == F.size("pixels")), F.lit(False)))
    side = F.col("side")
    gx0, gy0 = _grid(F.col("sx0"), side, width), _grid(F.col("sy0"), side, height)
    gridded = sized.withColumns({"gx0": gx0, "gy0": gy0})
    gx1 = F.greatest(F.col("gx0") + 1, F.ceil(F.col("sx1") * side / width).cast("int"))
    gy1 = F.greatest(F.col("gy0") + 1, F.ceil(F.col("sy1") * side / height).cast("int"))
    gridded = gridded.withColumns({"gx1": F.least(gx1, side), "gy1": F.least(gy1, side)})
    crop = P.nearest_resize("pixels", side, F.col("gy0"), F.col("gy1"), F.col("gx0"), F.col("gx1"), OUT, OUT)
    out = gridded.withColumn("crop", F.when(F.col("whole"), crop))
    if tee:
        # one pass: each row yields the rows of its stages
        def stage(name: str, *values):
            return F.struct(F.lit(name).alias("stage"), "frame_id", F.array(*[v.cast("double") for v in values]).alias("values"))

        rows = F.array(stage("centre", F.col("cx"), F.col("cy"), F.round("max_dist", 6)),
                       stage("box", *[F.col(c) for c in ("gx0", "gy0", "gx1", "gy1")]),
                       F.struct(F.lit("crop").alias("stage"), "frame_id", F.col("crop").cast("array<double>").alias("values")))
        out.select(F.inline(rows)).write.mode("overwrite").partitionBy("stage").parquet(tee)
    return out.select("frame_id", *keep, F.col("crop").alias("pixels"), (~F.col("whole")).alias("is_reject"))


def picture_crops(pictures: DataFrame, landmarks: DataFrame, width: int = G.FRAME_W,
                  height: int = G.FRAME_H, keep: tuple[str, ...] = (), out: int = OUT) -> DataFrame:
    """``(frame_id, pixels, is_reject)``: the square hand box of each decoded
    picture (``height``, ``width``, interleaved ``bgr``), cut out at the
    picture's own size, each channel resized to ``out`` x ``out`` (bilinear),
    then grey.  ``width`` and ``height`` are those of the landmarks' canvas.
    Pictures of one channel (grey) or four (with alpha) count as colour ones;
    a picture with another number of values is flagged, with null pixels."""
    boxes = G.boxes_for_frames(pictures, landmarks, keep=("height", "width", "bgr", *keep))
    h, w = F.col("height"), F.col("width")

    def low(c, n, size: int):
        return F.greatest(F.lit(0), F.least(_grid(F.col(c), n, size), n - 1))

    def high(c, start, n, size: int):
        return F.least(F.greatest(F.col(start) + 1, F.ceil(F.col(c) * n / size).cast("int")), n)

    channels = F.when((h > 0) & (w > 0) & (F.size("bgr") % (h * w) == 0), (F.size("bgr") / (h * w)).cast("int"))
    rows = boxes.withColumn("bgr", P.to_bgr("bgr", channels)).withColumn("whole", F.col("bgr").isNotNull())
    rows = rows.withColumns({"gx0": low("sx0", w, width), "gy0": low("sy0", h, height)})
    rows = rows.withColumns({"gx1": high("sx1", "gx0", w, width), "gy1": high("sy1", "gy0", h, height)})
    rows = rows.withColumns({"ch": F.col("gy1") - F.col("gy0"), "cw": F.col("gx1") - F.col("gx0")})
    cut = P.flatten(P.crop("bgr", w * 3, F.col("gy0"), F.col("gy1"), F.col("gx0") * 3, F.col("gx1") * 3))
    rows = rows.withColumn("cut", F.when(F.col("whole"), cut))

    rows = rows.withColumns({f"c{c}": P.channel("cut", c) for c in range(3)})
    rows = rows.withColumns({f"r{c}": P.bilinear_resize(f"c{c}", "ch", "cw", out, out) for c in range(3)})
    mixed = P.interleave("r0", "r1", "r2")
    small = rows.withColumn("small", F.when(F.col("whole"), mixed))
    return small.select("frame_id", *keep, F.when(F.col("whole"), P.bgr_to_grey("small")).alias("pixels"),
                        (~F.col("whole")).alias("is_reject"))


def debug_tee(frames: DataFrame, landmarks: DataFrame) -> DataFrame:
    """Run :func:`hand_crops` with the stage tee on; return the tee rows."""
    spark = frames.sparkSession
    path = fresh_path(spark, "tee")
    hand_crops(frames, landmarks, tee=path)
    return spark.read.parquet(path)


def training_rows(pictures: DataFrame, out: int = OUT) -> DataFrame:
    """``(frame_id, label, pixels)``: every BGR picture -> grey -> ``out`` x ``out``
    (bilinear, from the picture's own height and width)."""
    grey = pictures.select("frame_id", "label", "height", "width", P.bgr_to_grey("bgr").alias("grey"))
    return grey.select("frame_id", "label",
                       P.bilinear_resize("grey", "height", "width", out, out).alias("pixels"))


def dataset_rows(pictures: DataFrame, side: int) -> DataFrame:
    """``label, pixel_0 …``: every BGR picture -> ``side`` x ``side`` (bilinear, each channel) -> grey -> one
    column a pixel."""
    planes = pictures.withColumns({f"r{c}": P.bilinear_resize(P.channel("bgr", c), "height", "width", side, side) for c in range(3)})
    grey = planes.select("label", P.bgr_to_grey(P.interleave("r0", "r1", "r2")).alias("pixels"))
    return grey.select("label", *P.to_columns("pixels", side * side))


def frame_records(pictures: DataFrame, stream_col: str = "stream_name", order_col: str = "frame_id", side: int = 28) -> DataFrame:
    """Video frame records ``(stream, frame_number, metadata, pixel_data, grey_data)``: the number of each
    frame in its stream from 0, its size as JSON, and its pixels as ``side`` x ``side`` bytes, BGR and grey.
    Numbers are positions by ``order_col`` over ranges, so one long stream spans many tasks."""
    numbered = ranked(pictures, [stream_col], [order_col], "n").withColumn("frame_number", (F.col("n") - 1).cast("int"))
    channels = (F.size("bgr") / (F.col("height") * F.col("width"))).cast("int")
    planes = numbered.withColumn("channels", channels).withColumn("bgr", P.to_bgr("bgr", "channels"))
    planes = planes.withColumns({f"r{c}": P.bilinear_resize(P.channel("bgr", c), "height", "width", side, side) for c in range(3)})
    small = planes.withColumn("small", P.interleave("r0", "r1", "r2"))
    meta = F.struct(F.col("height").alias("Height"), F.col("width").alias("Width"), F.col("channels").alias("Channels"))
    return small.select(stream_col, "frame_number", F.to_json(meta).alias("metadata"), P.ints_to_bytes("small").alias("pixel_data"),
                        P.ints_to_bytes(P.bgr_to_grey("small")).alias("grey_data"))
