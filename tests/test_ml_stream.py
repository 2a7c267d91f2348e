"""Model and streaming behaviour that SQL cannot state."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from framewise.operators import ml as M
from framewise.operators import scoring as SC
from framewise.session import fresh_path
from framewise.sources import fixtures as fx


def _training(spark, sf_dir):
    return M.training_frames(fx.frames(spark, sf_dir))


def test_random_forest_beats_chance_and_survives_save_load(spark, sf_dir):
    t = _training(spark, sf_dir)
    model = M.fit(M.random_forest(), t.where("is_train"))
    held = M.scored(model, t.where("NOT is_train"))
    acc = M.evaluate_accuracy(held.withColumn("target", F.col("target")))
    assert acc > 0.3  # four classes
    loaded = M.save_and_load(model, fresh_path(spark, "rf"))
    again = M.scored(loaded, t.where("NOT is_train"))
    assert held.subtract(again).count() == 0


def test_served_model_scores_like_the_pipeline(spark, sf_dir):
    fr = fx.frames(spark, sf_dir)
    udf = SC.served_udf(n_pixels=64)
    mine = fr.select("frame_id", udf(F.col("pixels").cast("array<double>")).alias("p"))
    both = mine.join(SC.linear_model().transform(fr), "frame_id")
    assert both.count() == fr.count()
    assert both.where(~F.col("p").eqNullSafe(F.col("prediction"))).count() == 0


def test_linear_model_survives_save_load_and_odd_pixels(spark):
    rows = spark.createDataFrame([(1, [0] * 7), (2, list(range(49))), (3, None), (4, [])], "id int, pixels array<int>")
    model = SC.linear_model()
    loaded = M.save_and_load(model, fresh_path(spark, "linear"))
    got = {r.id: r.prediction for r in loaded.transform(rows).collect()}
    best = [sum(p * ((i * (2 * k + 1) + 7 * k) % 23 - 11) for i, p in enumerate(range(49))) for k in range(29)]
    assert got == {1: 0, 2: best.index(max(best)), 3: None, 4: 0}


def test_perceptron_learns(spark, sf_dir):
    t = _training(spark, sf_dir)
    held = M.scored(M.fit(M.mlp(), t.where("is_train")), t.where("NOT is_train"))
    assert M.evaluate_accuracy(held) > 0.6  # chance is a quarter; 0.76 was measured


def test_burst_letters_in_bounded_batches_with_a_restart(spark, sf_dir):
    """One file a batch, a restart between two arrivals, every burst present, equal to the batch flow."""
    from framewise.plans import ml_queries as Q
    from framewise.streaming import feeder
    from framewise.streaming import queries as SQ
    fr = fx.frames(spark, sf_dir)
    root, out, ckpt = (fresh_path(spark, k) for k in ("bl-in", "bl-out", "bl-ckpt"))
    for half in (F.col("frame_id") % 2 == 0, F.col("frame_id") % 2 == 1):
        feeder.write_bursts(fr.where(half), root)
        Q.burst_letters(spark, root, max_files=1, out=out, checkpoint=ckpt)
    got = SQ.latest_per_key(spark, out, ["burst"])
    want = E.queries()["stream_burst_letters"](spark, sf_dir)
    assert got.count() == want.count() == feeder.burst_records(fr).select("Filename").distinct().count()
    assert got.subtract(want).count() == 0


def test_update_mode_stream_equals_batch(spark, sf_dir):
    got = E.queries()["stream_max_letter"](spark, sf_dir)
    from framewise.sources.tables import table
    want = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_type").alias("max_letter"))
    assert got.count() == want.count()
    assert got.subtract(want).count() == 0


def test_late_half_is_dropped(spark, sf_dir):
    fr = fx.frames(spark, sf_dir)
    half = fr.count() // 2
    out = E.queries()["stream_late_data"](spark, sf_dir)
    earliest_kept = out.agg(F.min("window_start")).first()[0]
    first_late_second = fr.where(F.col("frame_id") >= half).agg(
        F.date_format(F.date_trunc("second", F.min("ts")), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert earliest_kept >= first_late_second


def test_label_index_round_trip(spark, sf_dir):
    from pyspark.ml.feature import IndexToString
    out = E.queries()["ml_label_index"](spark, sf_dir)
    model_labels = (out.select("label_token", "token_index").distinct()
                       .orderBy("token_index").collect())
    labels = [r.label_token for r in model_labels]
    back = IndexToString(inputCol="token_index", outputCol="token_back", labels=labels).transform(out)
    assert back.where(F.col("token_back") != F.col("label_token")).count() == 0


def test_parallel_sinks_write_both(spark, sf_dir):
    from framewise.streaming import feeder
    root = feeder.write_bursts(fx.frames(spark, sf_dir), fresh_path(spark, "par-in"))
    from framewise.streaming import queries as SQ
    stream = SQ.burst_stream(spark, root)
    raw, px = SQ.run_append_parallel([
        (stream.drop("timestamp"), "parquet", None, "raw"),
        (SQ.explode_stream_pixels(stream), "parquet", None, "px")])
    n = fx.frames(spark, sf_dir).count()
    assert spark.read.parquet(raw).count() == n
    assert spark.read.parquet(px).count() == n * 64


def test_wide_csv_pair_trains_through_vector_assembler(spark, sf_dir):
    """Train/test CSV pair (two paths read in one scan), wide pixel columns
    assembled into a vector inside the pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from framewise.functions import pixels as P
    from framewise.sources import files as IO
    t = _training(spark, sf_dir)
    wide = t.select("frame_id", "target", "is_train", *P.to_columns("pixels", 64, prefix="pixel"))
    train_p = IO.write_csv(wide.where("is_train").drop("is_train"), fresh_path(spark, "train"))
    test_p = IO.write_csv(wide.where("NOT is_train").drop("is_train"), fresh_path(spark, "test"))
    both = spark.read.csv([train_p, test_p], header=True, inferSchema=True)
    assert both.count() == t.count()
    cols = [f"pixel{i}" for i in range(64)]
    stages = M.wide_features(cols) + [RandomForestClassifier(labelCol="target", seed=42)]
    train = spark.read.csv(train_p, header=True, inferSchema=True)
    test = spark.read.csv(test_p, header=True, inferSchema=True)
    model = Pipeline(stages=stages).fit(train)
    pred = model.transform(test).select("target", "prediction")
    assert M.evaluate_accuracy(pred) > 0.3


def test_table_stream_reads_a_folder_of_part_files(spark, sf_dir):
    from framewise.schemas import EVENTS
    from framewise.sources.tables import table
    from framewise.streaming import queries as SQ
    root = fresh_path(spark, "parted")
    table(spark, sf_dir, "events").repartition(3).write.parquet(f"{root}/events.parquet")
    for base in (root, sf_dir):
        out = SQ.run_append(SQ.table_stream(spark, base, "events", EVENTS), kind="tbl")
        assert spark.read.parquet(out).count() == table(spark, sf_dir, "events").count()


def test_backlog_drained_in_bounded_batches(spark, sf_dir):
    from framewise.schemas import EVENTS
    from framewise.sources.tables import table
    from framewise.streaming import queries as SQ
    root = fresh_path(spark, "backlog")
    table(spark, sf_dir, "events").repartition(4).write.parquet(f"{root}/events.parquet")
    stream = SQ.table_stream(spark, root, "events", EVENTS, max_files_per_batch=1)
    q, out = SQ._start_append(stream, "parquet", None, "backlog-out", None, None)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4
    assert spark.read.parquet(out).count() == table(spark, sf_dir, "events").count()
