"""CSV arrays, line pieces, previews and the picture flows beyond what SQL states."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from framewise.operators import dataset as D
from framewise.operators import labels as L
from framewise.operators import scoring as SC
from framewise.plans.ml_queries import line_pieces, transcripts
from framewise.session import fresh_path
from framewise.sources import files as IO
from framewise.sources import fixtures as fx
from framewise.sources import images as IMG


def test_csv_column_positions_over_several_splits(spark):
    """One file read in many splits: every value has its place in the file."""
    path = fresh_path(spark, "column")
    spark.range(30_000).selectExpr("cast((id * 7919) % 256 as int) as Pixel").coalesce(1).write.option("header", True).csv(path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert spark.read.csv(path).rdd.getNumPartitions() > 5
        rows = IO.read_csv_column(spark, path, "Pixel", "INT").orderBy("position").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r.position for r in rows] == list(range(30_000))
    assert [r.Pixel for r in rows] == [(i * 7919) % 256 for i in range(30_000)]


def test_csv_row_arrays(spark):
    path = fresh_path(spark, "rows")
    spark.createDataFrame([("1, 2.5,255",), ("7",), ("x,,3",)], "value string").coalesce(1).write.text(path)
    got = [r["values"] for r in IO.read_csv_rows_as_arrays(spark, path).collect()]
    assert sorted(got, key=str) == sorted([[1.0, 2.5, 255.0], [7.0], [None, None, 3.0]], key=str)


def test_pieces_joined_are_the_line(spark, sf_dir):
    fr = fx.frames(spark, sf_dir).select("frame_id", "stream_name", "ts", F.col("label").alias("label_id"))
    lettered = L.lookup(fr, fx.labels_dim(spark), "label_id")
    whole = {(r.stream_name, r.minute): r.line for r in transcripts(lettered).collect()}
    timed = lettered.withColumn("minute", F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm"))
    pieces = line_pieces(timed, piece=7).orderBy("piece_no").collect()
    joined: dict = {}
    for r in pieces:
        joined[r.stream_name, r.minute] = joined.get((r.stream_name, r.minute), "") + r.text
    assert joined == whole and len(pieces) > 3 * len(whole)


def test_random_preview_is_poisson_and_stable(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "key")
    for fraction in (0.3, 2.0):
        drawn = D.random_preview(rows, "key", fraction, seed=5)
        times = Counter(Counter(r.key for r in drawn.collect()).values())
        n = sum(k * c for k, c in times.items())
        assert abs(n - fraction * 20_000) < 5 * (fraction * 20_000) ** 0.5 and times[2] > 0
        again = D.random_preview(rows.repartition(7), "key", fraction, seed=5)
        assert again.exceptAll(drawn).count() == 0 == drawn.exceptAll(again).count()
    assert D.random_preview(rows, "key", 0.3, seed=6).exceptAll(D.random_preview(rows, "key", 0.3, seed=5)).count() > 0
    assert D.random_preview(rows, "key", 0.0).count() == 0


def test_unknown_names_are_one_class(spark):
    names = spark.createDataFrame([("/x/A_1.jpg",), ("/x/junk_2.jpg",), ("/x/space_3.v1.jpg",), ("/x/b.jpg",)], "path string")
    got = {r.path: r.label_token for r in L.with_known_label(names, fx.labels_dim(spark)).collect()}
    assert got == {"/x/A_1.jpg": "A", "/x/junk_2.jpg": "other", "/x/space_3.v1.jpg": "space", "/x/b.jpg": "other"}


def test_picture_read_half_has_no_python(spark):
    images = spark.createDataFrame([((b"\x01\x02\x03", "f", 1, 1, 3),)],
                                   "image struct<data:binary,origin:string,height:int,width:int,nChannels:int>")
    out = IO.image_pixels(images)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and out.first().pixels == [1, 2, 3]


def test_small_pictures_share_tasks(spark):
    """600 files of a few bytes: not one task for every 32 of them, and no file is lost."""
    root = fresh_path(spark, "small-pictures")
    rows = spark.range(600).select(F.col("id").alias("frame_id"), F.array(F.lit(1), F.lit(2)).alias("pixels"))
    IMG.write_pngs(rows, root, 1, 2).write.format("noop").mode("overwrite").save()
    images = IO.read_images(spark, root)
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert images.rdd.getNumPartitions() <= least
    assert IO.image_pixels(images).select("origin").distinct().count() == 600


def test_scores_of_frames_of_any_length(spark):
    """As the weights say, pixel by pixel."""
    values = [list(range(200, 200 + n)) for n in (0, 1, 22, 23, 24, 784)] + [None, [3, None, 4]]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, px array<int>")
    scored = rows.select("i", SC.linear_class(F.col("px")).alias("k"))

    def plain(px):
        if px is None or None in px:
            return None
        scores = [sum(p * ((i * (2 * k + 1) + 7 * k) % 23 - 11) for i, p in enumerate(px)) for k in range(29)]
        return scores.index(max(scores))

    assert {r.i: r.k for r in scored.collect()} == {i: plain(v) for i, v in enumerate(values)}
