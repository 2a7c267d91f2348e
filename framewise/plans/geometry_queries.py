"""Registered geometry queries over ``landmarks`` and ``frames``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry as G
from ..sources import fixtures as fx
from .catalog import register

_G = ("landmarks", "frames")
_H = """h AS (SELECT frame_id, hand_id, CAST(trunc(sum(x) * 1.0 / count(*)) AS INT) AS hx,
                 CAST(trunc(sum(y) * 1.0 / count(*)) AS INT) AS hy FROM fx_landmarks GROUP BY frame_id, hand_id),
c AS (SELECT frame_id, CAST(trunc(sum(hx) * 1.0 / count(*)) AS INT) AS cx,
             CAST(trunc(sum(hy) * 1.0 / count(*)) AS INT) AS cy FROM h GROUP BY frame_id)"""
_M = _H + """,
m AS (SELECT l.frame_id, max(cx) AS cx, max(cy) AS cy,
             max(sqrt(power(cx - x, 2) + power(cy - y, 2))) AS md
      FROM fx_landmarks l JOIN c ON l.frame_id = c.frame_id GROUP BY l.frame_id)"""
_B = _M + """,
d AS (SELECT f.frame_id, m.frame_id IS NULL AS no_hand, coalesce(cx, 320) AS cx, coalesce(cy, 240) AS cy,
             CAST(coalesce(md, 640) AS DOUBLE) AS md
      FROM fx_frames f LEFT JOIN m ON f.frame_id = m.frame_id),
b AS (SELECT frame_id, no_hand, cx, cy, md,
             greatest(0, CAST(trunc(cx - 2 * md) AS INT)) AS x0, greatest(0, CAST(trunc(cy - 2 * md) AS INT)) AS y0,
             least(640, CAST(trunc(cx + 2 * md) AS INT)) AS x1, least(480, CAST(trunc(cy + 2 * md) AS INT)) AS y1
      FROM d),
g AS (SELECT *, CASE WHEN x1 - x0 > y1 - y0 THEN CAST(floor((x1 - x0 - (y1 - y0)) / 2.0) AS INT) ELSE 0 END AS dx,
             CASE WHEN y1 - y0 > x1 - x0 THEN (y1 - y0) - (x1 - x0) ELSE 0 END AS dy FROM b)"""


def _boxes(spark, sf):
    return G.boxes_for_frames(fx.frames(spark, sf), fx.landmarks(spark, sf))


_BOX_COLS = ["frame_id", "cx", "cy", "max_dist", "x0", "y0", "x1", "y1"]


@register("landmark_to_pixels", fixtures=("landmarks",),
          sql="SELECT frame_id, hand_id, pos, x, y FROM fx_landmarks")
def landmark_to_pixels(spark, sf):
    return fx.landmarks(spark, sf)


@register("hand_center", fixtures=("landmarks",), sql=f"WITH {_H} SELECT frame_id, cx, cy FROM c")
def hand_center(spark, sf):
    return G.hand_centers(fx.landmarks(spark, sf))


@register("hand_max_distance", fixtures=("landmarks",),
          sql=f"WITH {_M} SELECT frame_id, cx, cy, round(md, 6) AS max_dist FROM m")
def hand_max_distance(spark, sf):
    r = G.hand_reach(fx.landmarks(spark, sf))
    return r.withColumn("max_dist", F.round("max_dist", 6))


@register("crop_box", fixtures=_G, sql=f"""WITH {_B}
SELECT frame_id, cx, cy, round(md, 6) AS max_dist, x0, y0, x1, y1 FROM b""")
def crop_box(spark, sf):
    return _boxes(spark, sf).withColumn("max_dist", F.round("max_dist", 6)).select(*_BOX_COLS)


@register("crop_box_square", fixtures=_G, sql=f"""WITH {_B}
SELECT frame_id, x0 + dx AS sx0, x1 - dx AS sx1,
       y0 + CAST(floor(dy / 2.0) AS INT) AS sy0, y1 - CAST(floor(dy / 2.0) AS INT) AS sy1,
       y0 + dy AS compat_y0, y1 - dy AS compat_y1 FROM g""")
def crop_box_square(spark, sf):
    both = G.square_box(_boxes(spark, sf), exact_compat=True,
                        names=("", "", "compat_y0", "compat_y1"))
    return both.select("frame_id", "sx0", "sx1", "sy0", "sy1", "compat_y0", "compat_y1")


@register("crop_box_no_hand", fixtures=_G, sql=f"""WITH {_B}
SELECT frame_id, cx, cy, round(md, 6) AS max_dist, x0, y0, x1, y1 FROM b WHERE no_hand""")
def crop_box_no_hand(spark, sf):
    b = _boxes(spark, sf).where("no_hand")
    return b.withColumn("max_dist", F.round("max_dist", 6)).select(*_BOX_COLS)
