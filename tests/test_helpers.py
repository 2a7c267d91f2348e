"""Helpers without a query key of their own: grouped-pandas cross-check of
the dispersion statistics, text-line sink, polling service, previews."""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import functions as F

from framewise.operators import dataset as D
from framewise.operators import survey as S
from framewise.session import fresh_path
from framewise.sources import files as IO
from framewise.sources import fixtures as fx
from framewise.streaming import feeder
from framewise.streaming import queries as SQ


def test_dispersion_matches_grouped_pandas(spark, sf_dir):
    """The application computed variance/std/CV in Python per group; the same
    numbers from ``applyInPandas`` equal the built-in aggregates."""
    base = S.hearing_loss(fx.survey(spark, sf_dir)).where(F.col("VALUE").isNotNull()) \
            .select("Age_group", "Sex", "VALUE")

    def stats(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["VALUE"].tolist()
        n = len(v)
        mean = sum(v) / n
        var = sum((x - mean) ** 2 for x in v) / n
        if n <= 1 or not var > 0:
            return pd.DataFrame(columns=["Age_group", "Sex", "variance", "mean"])
        return pd.DataFrame({"Age_group": [pdf["Age_group"].iloc[0]], "Sex": [pdf["Sex"].iloc[0]],
                             "variance": [round(var, 6)], "mean": [round(mean, 6)]})

    py = base.groupBy("Age_group", "Sex").applyInPandas(
        stats, "Age_group string, Sex string, variance double, mean double")
    builtin = S.dispersion(fx.survey(spark, sf_dir)).select("Age_group", "Sex", "variance", "mean")
    a = {(r.Age_group, r.Sex): (r.variance, r.mean) for r in builtin.collect()}
    b = {(r.Age_group, r.Sex): (r.variance, r.mean) for r in py.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert abs(a[k][0] - b[k][0]) < 1e-5 and abs(a[k][1] - b[k][1]) < 1e-5


def test_append_lines_accumulates(spark, sf_dir):
    from framewise.plans.ml_queries import transcripts
    fr = fx.frames(spark, sf_dir).select("frame_id", "stream_name", "ts", F.col("label").alias("label_id"))
    lines = transcripts(fr.join(F.broadcast(fx.labels_dim(spark)), "label_id")) \
        .select(F.concat_ws(" ", "stream_name", "minute", "line").alias("line"))
    path = fresh_path(spark, "lines")
    IO.append_lines(lines, path)
    IO.append_lines(lines, path)
    assert spark.read.text(path).count() == 2 * lines.count()


def test_polling_service_runs_for_a_while(spark, sf_dir):
    root = feeder.write_bursts(fx.frames(spark, sf_dir), fresh_path(spark, "svc-in"))
    stream = SQ.explode_stream_pixels(SQ.burst_stream(spark, root))
    out = fresh_path(spark, "svc-out")
    q = SQ.start_service(stream, "parquet", out, fresh_path(spark, "svc-ckpt"), every="1 second")
    deadline = time.time() + 60
    while time.time() < deadline and not q.recentProgress:
        time.sleep(0.5)
    q.processAllAvailable()
    SQ.run_for(q, 1)
    assert not q.isActive
    assert spark.read.parquet(out).count() == fx.frames(spark, sf_dir).count() * 64


def test_previews(spark, sf_dir):
    docs = fx.pred(spark, sf_dir)
    first = D.first_n(docs, ["sample_id"], 5).collect()
    assert [r.sample_id for r in first] == [0, 1, 2, 3, 4]
    sample = D.random_preview(docs, "sample_id", 0.5, seed=7).drop("copy")
    assert sample.count() > 0
    assert sample.join(docs, "sample_id", "left_anti").count() == 0


def test_registered_inputs_hold_the_derived_rows(spark, sf_dir):
    from framewise.plans.sql_views import VIEWS, register_views
    assert register_views(spark, sf_dir) == list(VIEWS)
    for name, build in VIEWS.items():
        assert spark.table(name).count() == build(spark, sf_dir).count()


def test_approx_quartiles_equal_exact_at_high_accuracy(spark, sf_dir):
    sv = fx.survey(spark, sf_dir)
    exact = S.quartiles(sv)
    approx = S.quartiles_approx(sv, accuracy=1_000_000)
    assert exact.count() == approx.count()
    assert exact.exceptAll(approx).count() == 0


def test_cluster_conf_sizes_partitions():
    from framewise.session import cluster_conf
    c = cluster_conf(100 * 2 ** 40, executors=1000, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600   # one per 256 MB
    small = cluster_conf(10 * 2 ** 30, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 80    # at least 2 waves
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_hand_crops_of_frames_and_pictures_of_other_sizes(spark):
    from framewise.operators import prep as PR

    marks = spark.createDataFrame([], "frame_id long, hand_id int, pos int, x int, y int")  # no hand: 480 x 480 in the middle
    frames = spark.createDataFrame([(1, list(range(64))), (2, list(range(100))), (3, list(range(60)))], "frame_id long, pixels array<int>")
    got = {r.frame_id: r for r in PR.hand_crops(frames, marks).collect()}
    assert len(got[1].pixels) == len(got[2].pixels) == 16 and not got[1].is_reject and not got[2].is_reject
    assert got[2].pixels[0] == 1 and got[2].pixels[-1] == 77  # columns 1 to 8 of ten, all rows
    assert got[3].pixels is None and got[3].is_reject
    # 8 rows of 12: the box is columns 1 to 10, blue only, the same in a column
    bgr = [v for _ in range(8) for x in range(12) for v in (x * 20, 0, 0)]
    pictures = spark.createDataFrame([(1, 8, 12, bgr), (2, 8, 12, bgr[:-1]), (3, -1, -1, [])],
                                     "frame_id long, height int, width int, bgr array<int>")
    rows = {r.frame_id: r for r in PR.picture_crops(pictures, marks).collect()}
    blue = [20 * (1 + min(max((c + 0.5) * 10 / 4 - 0.5, 0), 9)) for c in range(4)]
    assert rows[1].pixels == [(round(b) * 114 + 500) // 1000 for b in blue] * 4 and not rows[1].is_reject
    assert all(rows[i].is_reject and rows[i].pixels is None for i in (2, 3))
