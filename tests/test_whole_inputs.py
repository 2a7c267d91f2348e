"""Inputs of other sizes than those of the given tables: nothing is cut off, and what does not fit is flagged."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framewise.functions import pixels as P
from framewise.operators import geometry as G
from framewise.operators import ml as M
from framewise.operators import prep as PR


def test_quarters_of_longer_frames(spark):
    """64 black and 64 white values: the first 64 alone would be class 0."""
    rows = spark.createDataFrame([(1, [0] * 64 + [255] * 64), (2, [9] + [0] * 63), (3, [0] * 8 + [1, 1, 7]), (4, [5, 5, 5])], "frame_id long, pixels array<int>")
    got = {r.frame_id: int(r.target) for r in M.training_frames(rows).collect()}
    assert got == {1: 2, 2: 0, 3: 3, 4: 3}  # 11 values: the last quarter has 5; 3 values: all in the last


def test_square_frames_of_any_side(spark):
    marks = spark.createDataFrame([], "frame_id long, hand_id int, pos int, x int, y int")
    frames = spark.createDataFrame([(1, list(range(49))), (2, list(range(50))), (3, []), (4, None), (5, [7])], "frame_id long, pixels array<int>")
    got = {r.frame_id: r for r in PR.hand_crops(frames, marks).collect()}
    assert [got[i].is_reject for i in (1, 2, 3, 4, 5)] == [False, True, True, True, False]
    assert got[2].pixels is None and got[5].pixels == [7] * 16
    # without a hand the box is the picture's middle square: all 7 rows, 7 columns less what the square cuts off
    assert len(got[1].pixels) == 16 and all(0 <= p < 49 for p in got[1].pixels) and max(got[1].pixels) > 36


def test_pictures_of_one_and_four_channels(spark):
    marks = spark.createDataFrame([(i, 0, k, 320 + k, 240) for i in range(1, 6) for k in range(4)], "frame_id long, hand_id int, pos int, x int, y int")
    grey = [(y * 12 + x) % 251 for y in range(8) for x in range(12)]
    bgr = [v for g in grey for v in (g, g, g)]
    bgra = [v for i, g in enumerate(grey) for v in (g, g, g, i % 256)]
    rows = [(1, 8, 12, grey), (2, 8, 12, bgr), (3, 8, 12, bgra), (4, 8, 12, grey + grey), (5, 8, 12, bgr[:-1])]
    got = {r.frame_id: r for r in PR.picture_crops(spark.createDataFrame(rows, "frame_id long, height int, width int, bgr array<int>"), marks).collect()}
    assert got[1].pixels == got[2].pixels == got[3].pixels and len(got[1].pixels) == 16
    assert [got[i].is_reject for i in range(1, 6)] == [False, False, False, True, True] and got[4].pixels is None


def test_reshape_and_pooling_by_each_frames_own_size(spark):
    rows = spark.createDataFrame([(1, 2, 3, [1, 2, 3, 4, 5, 6]), (2, 1, 6, [1, 2, 3, 4, 5, 6]), (3, 2, 2, [1, 2, 3])], "id int, h int, w int, px array<int>")
    got = {r.id: r for r in rows.select("id", P.reshape("px", "h", "w").alias("grid"), P.pool_mean("px", "h", "w").alias("pool")).collect()}
    assert got[1].grid == [[1, 2, 3], [4, 5, 6]] and got[1].pool == [3.0, 4.5]
    assert got[2].grid == [[1, 2, 3, 4, 5, 6]] and got[2].pool == [1.5, 3.5, 5.5]
    assert got[3].grid is None and got[3].pool is None


def test_wide_layouts_take_the_longest_frame(spark):
    rows = spark.createDataFrame([(1, list(range(64))), (2, list(range(128))), (3, None)], "id int, pixels array<int>")
    n = P.longest(rows)
    assert n == 128
    wide = {r.id: r for r in rows.select("id", *P.to_columns("pixels", n)).collect()}
    assert wide[2].pixel_127 == 127 and wide[1].pixel_127 is None and wide[1].pixel_63 == 63
    assert P.longest(rows.where("id = 3")) == 0
    with pytest.raises(ValueError):
        P.longest(spark.range(1).select(F.array_repeat(F.lit(1), P.MAX_WIDTH + 1).alias("pixels")))


def test_bytes_and_numbers(spark):
    values = [list(range(256)), [], [0], [255, 10, 13, 128], None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, px array<int>")
    packed = rows.select("i", "px", P.ints_to_bytes("px").alias("data"))
    for r in packed.select("i", "px", "data", P.bytes_to_ints("data").alias("back")).collect():
        assert r.back == r.px and (r.data is None if r.px is None else bytes(r.data) == bytes(r.px))
    plan = packed.select(P.bytes_to_ints("data"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    bad = spark.createDataFrame([(1, [256]), (2, [-1]), (3, [1, None])], "i int, px array<int>")
    assert all(r.data is None for r in bad.select(P.ints_to_bytes("px").alias("data")).collect())


def test_resize_works_out_places_once_per_row_and_column(spark):
    """One rounding down for each axis in the whole expression, none for every cell's neighbours."""
    out = spark.range(1).select(F.array_repeat(F.lit(7), 6).alias("px")).select(P.bilinear_resize("px", 2, 3, 5, 4).alias("r"))
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("floor(") <= 2
    odd = spark.createDataFrame([(1, [7, 255, None, 9], 2, 2), (2, None, 2, 2), (3, [5], 2, 2)], "i int, px array<int>, h int, w int")
    got = {r.i: r.r for r in odd.select("i", P.bilinear_resize("px", "h", "w", 2, 2).alias("r")).collect()}
    assert got == {1: [0, 255, 0, 9], 2: None, 3: [0, 0, 0, 0]}  # 0 where one of the four sources is missing


def test_frame_records(spark):
    rows = [(7, "s", 2, 2, [1] * 12), (3, "s", 2, 2, [200, 100, 50] * 4), (5, "t", 1, 1, [9])]
    got = PR.frame_records(spark.createDataFrame(rows, "frame_id long, stream_name string, height int, width int, bgr array<int>"), side=3)
    by = {(r.stream_name, r.frame_number): r for r in got.collect()}
    assert set(by) == {("s", 0), ("s", 1), ("t", 0)}
    assert by["s", 0].metadata == '{"Height":2,"Width":2,"Channels":3}' and bytes(by["s", 0].pixel_data) == bytes([200, 100, 50] * 9)
    assert bytes(by["s", 1].grey_data) == b"\1" * 9 and bytes(by["t", 0].pixel_data) == b"\x09" * 27


def test_a_hot_frame_spans_tasks(spark):
    """Four fifths of the points in one frame: they meet their centre in many tasks, with the same result."""
    points = spark.range(40_000).selectExpr("if(id % 5 = 0, id, 1) as frame_id", "0 as hand_id", "cast(id as int) as pos",
                                            "cast(id % 640 as int) as x", "cast(id % 480 as int) as y")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tasks = G.points_at_centre(points).where("frame_id = 1").groupBy(F.spark_partition_id().alias("task")).count().collect()
        reach = {r.frame_id: r for r in G.hand_reach(points).collect()}
        plain = {r.frame_id: r for r in G.hand_reach(points, salts=1).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 20_000 and sum(r["count"] for r in tasks) == 32_000
    assert reach == plain and len(reach) == 8_000 + 1 - (1 if 1 % 5 == 0 else 0)
