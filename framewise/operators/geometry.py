"""Hand geometry from landmark rows: centre, reach, crop box, square box.

Landmarks are rows ``(frame_id, hand_id, pos, x, y)``.  Centres are
two-level partial aggregates (points -> hands -> frame); the raw points are
shuffled once, to meet their centre.  There the points of a frame are dealt
to ``SALTS`` parts and its centre row is sent to each, so a frame id that
holds a large share of the rows spans as many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_W, FRAME_H = 640, 480
SALTS = 8  # parts the points of one frame are dealt to where they meet their centre


def _trunc_mean(c: str):
    return (F.sum(c) / F.count(F.lit(1))).cast("int")


def hand_centers(landmarks: DataFrame) -> DataFrame:
    """Per hand: truncated mean of the points; per frame: truncated mean of
    the hand centres -> ``(frame_id, cx, cy)``.  Both levels aggregate
    partially before their shuffle (points -> one row per hand per task)."""
    hands = landmarks.groupBy("frame_id", "hand_id").agg(_trunc_mean("x").alias("hx"),
                                                    _trunc_mean("y").alias("hy"))
    return hands.groupBy("frame_id").agg(_trunc_mean("hx").alias("cx"),
                                         _trunc_mean("hy").alias("cy"))


def points_at_centre(landmarks: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(frame_id, x, y, cx, cy)``: every point beside its frame's centre, joined on the frame and a
    salt of the point, the centres replicated over the salts."""
    salt = F.pmod(F.xxhash64("hand_id", "pos", "x", "y"), F.lit(salts)).cast("int")
    points = landmarks.select("frame_id", "x", "y", salt.alias("_salt"))
    centers = hand_centers(landmarks).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return points.join(centers, ["frame_id", "_salt"]).drop("_salt")


def hand_reach(landmarks: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(frame_id, cx, cy, max_dist)``: largest distance of a point to the centre.

    Centres come from the two-level partial aggregates (no raw-point shuffle); the points then meet
    their frame's centre in a salted join.  The maximum is taken twice: in each task over the points
    of a frame it holds, then over one row per frame and task."""
    dist = F.sqrt(F.pow(F.col("cx") - F.col("x"), 2) + F.pow(F.col("cy") - F.col("y"), 2))
    return (points_at_centre(landmarks, salts).groupBy("frame_id")
            .agg(F.max("cx").alias("cx"), F.max("cy").alias("cy"), F.max(dist).alias("max_dist")))


def with_defaults(frames: DataFrame, reach: DataFrame, width: int = FRAME_W,
                  height: int = FRAME_H, keep: tuple[str, ...] = ()) -> DataFrame:
    """Frames without a hand get the picture centre and a reach of its width.
    ``keep`` carries frame columns (e.g. the pixels) through the same join."""
    return (frames.select("frame_id", *keep).join(reach, "frame_id", "left")
            .select("frame_id", *keep,
                    F.col("cx").isNull().alias("no_hand"),
                    F.coalesce("cx", F.lit(width // 2)).alias("cx"),
                    F.coalesce("cy", F.lit(height // 2)).alias("cy"),
                    F.coalesce("max_dist", F.lit(float(width))).alias("max_dist")))


def crop_box(centred: DataFrame, width: int = FRAME_W, height: int = FRAME_H) -> DataFrame:
    """Box of twice the reach around the centre, clamped to the picture."""
    cx, cy, md = F.col("cx"), F.col("cy"), F.col("max_dist")
    return centred.withColumns({
        "x0": F.greatest(F.lit(0), (cx - md * 2).cast("int")),
        "y0": F.greatest(F.lit(0), (cy - md * 2).cast("int")),
        "x1": F.least(F.lit(width), (cx + md * 2).cast("int")),
        "y1": F.least(F.lit(height), (cy + md * 2).cast("int")),
    })


def square_box(boxes: DataFrame, exact_compat: bool = False,
               names: tuple[str, str, str, str] = ("sx0", "sx1", "sy0", "sy1")) -> DataFrame:
    """Trim the longer side to make the box square.

    Wide boxes lose ``(w-h) div 2`` on both sides.  Tall boxes lose
    ``(h-w) div 2`` on both sides, or with ``exact_compat`` the full ``h-w``
    on both sides as the application did (which over-trims).
    """
    w = F.col("x1") - F.col("x0")
    h = F.col("y1") - F.col("y0")
    dx = F.when(w > h, F.floor((w - h) / 2).cast("int")).otherwise(0)
    dy_full = F.when(h > w, h - w).otherwise(0)
    dy = dy_full if exact_compat else F.floor(dy_full / 2).cast("int")
    cols = {names[0]: F.col("x0") + dx, names[1]: F.col("x1") - dx,
            names[2]: F.col("y0") + dy, names[3]: F.col("y1") - dy}
    return boxes.withColumns({k: v for k, v in cols.items() if k})


def boxes_for_frames(frames: DataFrame, landmarks: DataFrame,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """All frames with centre, reach, box and square box (fixed trimming)."""
    return square_box(crop_box(with_defaults(frames, hand_reach(landmarks), keep=keep)))
