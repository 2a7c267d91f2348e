"""Physical-plan checks: pruning, broadcasts of bounded sides, top-k limits,
and the skew-safe ranking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from framewise.operators.ranking import ranked
from framewise.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_scan_is_pruned(spark, sf_dir):
    df = E.queries()["train_minus_test"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema:")[-1].split("\n")[0] or "struct<doc_id" in plan
    assert "struct<doc_id:bigint,lang:string>" in plan


def test_dictionary_is_broadcast(spark, sf_dir):
    plan = _plan(E.queries()["label_lookup"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan


def test_sample_rate_limits_before_shuffle(spark, sf_dir):
    df = E.queries()["frame_sample_rate"](spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan


def test_geometry_shuffles_points_once(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["hand_max_distance"](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # raw points are exchanged once (for the salted join); the centre side is partially aggregated
    # before each of its two small exchanges and replicated in a third; the maxima of a frame's
    # parts are aggregated in each task before the last
    salted = sum(line.count("_salt") > 0 and "Exchange hashpartitioning(frame_id" in line for line in plan.split("\n"))
    assert salted == 2 and plan.count("Exchange hashpartitioning(frame_id") == 5
    assert "partial_max" in plan
    assert "Window" not in plan


def test_ranked_equals_row_number_with_a_hot_group(spark, sf_dir):
    names = fx.image_names(spark, sf_dir)
    # a third of the rows share one folder
    df = names.select("file_id", F.when(F.col("file_id") % 3 == 0, "hot")
                      .otherwise(F.substring_index(F.substring_index("path", "/", -1), "_", 1))
                      .alias("folder"), F.col("path").alias("name"))
    mine = ranked(df, ["folder"], ["name"], partitions=16).select("file_id", "rn")
    w = Window.partitionBy("folder").orderBy("name")
    ref = df.select("file_id", F.row_number().over(w).cast("long").alias("rn"))
    assert mine.count() == ref.count()
    assert mine.subtract(ref).count() == 0


def test_exact_quantiles_equal_a_sort(spark, sf_dir):
    from framewise.operators.quantiles import exact_quantiles
    from framewise.sources.tables import table
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    qs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    a = exact_quantiles(li, ["l_returnflag"], "l_extendedprice", qs)
    assert a.count() == 3
    # against a sort of each group
    pdf = li.toPandas()
    import math
    for r in a.collect():
        vals = sorted(pdf[pdf.l_returnflag == r.l_returnflag].l_extendedprice)
        for name, q in qs.items():
            assert getattr(r, name) == vals[max(math.ceil(q * len(vals)), 1) - 1]


def test_hot_group_is_spread_over_partitions(spark, sf_dir):
    from framewise.operators.ranking import _placed
    names = fx.image_names(spark, sf_dir)
    df = names.select(F.when(F.col("file_id") % 3 == 0, "hot").otherwise("cold").alias("folder"),
                      F.col("path").alias("name"))
    placed = _placed(df, ["folder", "name"], 16)
    per_part = placed.where("folder = 'hot'").groupBy("_pid").count().collect()
    hot_rows = sum(r["count"] for r in per_part)
    assert len(per_part) >= 4
    assert max(r["count"] for r in per_part) < hot_rows / 2


def test_exact_quantiles_with_a_hot_and_a_null_group(spark):
    from framewise.operators.quantiles import exact_quantiles
    hot = F.when(F.col("id") % 10 == 0, F.lit(None).cast("string")).otherwise("hot")
    df = spark.range(1000).select(hot.alias("g"), (F.col("id") * 7919 % 1000).alias("v"))
    got = {r.g: r.m for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}, partitions=16).collect()}
    values = {g: sorted(i * 7919 % 1000 for i in range(1000) if (i % 10 == 0) == (g is None)) for g in (None, "hot")}
    assert got == {g: v[(len(v) + 1) // 2 - 1] for g, v in values.items()}


def test_survey_joins_only_what_it_needs(spark, sf_dir):
    for key, joins in [("survey_avg_age_sex", 1), ("survey_dispersion", 1), ("survey_avg_year", 1),
                       ("survey_confidence", 1), ("survey_avg_geo", 2)]:
        plan = _plan(E.queries()[key](spark, sf_dir)).split("== Initial Plan ==")[-1]
        assert sum(" Join" in line or "HashJoin" in line or "MergeJoin" in line for line in plan.split("\n")) == joins, key
        assert "EqualTo(l_returnflag,R)" in plan


def test_staged_survey_joins_orders_without_exchange(spark, sf_dir):
    from framewise.sources.staging import stage_survey_inputs, staged_survey
    names = stage_survey_inputs(spark, sf_dir, buckets=8)
    staged = staged_survey(spark, sf_dir, names)
    plain = fx.survey(spark, sf_dir)
    assert staged.count() == plain.count()
    assert staged.exceptAll(plain).count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = staged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(o_orderkey" not in plan
