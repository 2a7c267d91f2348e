"""Survey analytics: averages, dispersion, quartiles, pivots, regions.

Inputs are the ``survey`` facts (REF_DATE, GEO, Age_group, Sex, Categories,
Characteristics, VALUE) and the all-string ``sl_users`` table.  Every query
is a filter -> hash aggregate (partial on the map side, so a hot group never
gathers raw rows in one task) -> small final projection / sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import age_from, blank_to_null, try_double, try_int
from ..schemas import AGE_ORDER, EXCLUDED_AGE_GROUP
from .quantiles import exact_quantiles

HEARING_LOSS = "Hearing loss"


def _r6(c):
    return F.round(c, 6)


def hearing_loss(survey: DataFrame, exclude_all_ages: bool = True) -> DataFrame:
    cond = F.col("Categories") == HEARING_LOSS
    if exclude_all_ages:
        cond = cond & (F.col("Age_group") != EXCLUDED_AGE_GROUP)
    return survey.where(cond)


def avg_by_age_sex(survey: DataFrame) -> DataFrame:
    return (hearing_loss(survey)
            .groupBy("Age_group", "Sex")
            .agg(_r6(F.avg("VALUE")).alias("avg_hearing_loss"))
            .withColumn("age_from", age_from("Age_group"))
            .orderBy("age_from", "Sex"))


def range_rate(survey: DataFrame) -> DataFrame:
    """(max - min) / count(*) per age group; count(*) includes null values."""
    return (hearing_loss(survey)
            .groupBy("Age_group")
            .agg(_r6((F.max("VALUE") - F.min("VALUE")) / F.count(F.lit(1))).alias("rate_of_change"))
            .orderBy(age_from("Age_group")))


def avg_by_year(survey: DataFrame) -> DataFrame:
    return (hearing_loss(survey, exclude_all_ages=False)
            .groupBy("REF_DATE")
            .agg(_r6(F.avg("VALUE")).alias("avg_hearing_loss"))
            .orderBy("REF_DATE"))


def avg_by_geo(survey: DataFrame) -> DataFrame:
    return (hearing_loss(survey, exclude_all_ages=False)
            .groupBy("GEO")
            .agg(_r6(F.avg("VALUE")).alias("avg_hearing_loss"))
            .orderBy(F.desc("avg_hearing_loss"), "GEO"))


def confidence(survey: DataFrame) -> DataFrame:
    ch = F.col("Characteristics")
    return (hearing_loss(survey, exclude_all_ages=False)
            .groupBy("REF_DATE")
            .agg(_r6(F.avg("VALUE")).alias("avg_estimate"),
                 _r6(F.avg(F.when(ch.like("%Low%"), F.col("VALUE")))).alias("avg_low_confidence"),
                 _r6(F.avg(F.when(ch.like("%High%"), F.col("VALUE")))).alias("avg_high_confidence"))
            .orderBy("REF_DATE"))


def _dispersion_raw(survey: DataFrame) -> DataFrame:
    """Population variance / std / mean / CV per (Age_group, Sex); groups of one
    value and groups without spread are dropped, as the application did."""
    v = F.col("VALUE")
    return (hearing_loss(survey)
            .where(v.isNotNull())
            .groupBy("Age_group", "Sex")
            .agg(F.count(v).alias("_n"), F.var_pop(v).alias("variance"),
                 F.stddev_pop(v).alias("std_deviation"), F.avg(v).alias("mean"))
            .where((F.col("_n") > 1) & (F.col("variance") > 0) & ~F.isnan("variance"))
            .withColumn("cv", F.try_divide(F.col("std_deviation"), F.col("mean")))
            .drop("_n"))


def dispersion(survey: DataFrame) -> DataFrame:
    d = _dispersion_raw(survey)
    return d.select("Age_group", "Sex", *[_r6(F.col(c)).alias(c) for c in
                                          ("variance", "std_deviation", "mean", "cv")])


def age_order_key(age_group) -> F.Column:
    """1-based position in the fixed age order; unknown groups -> null (last)."""
    c = F.col(age_group) if isinstance(age_group, str) else age_group
    expr = None
    for i, band in enumerate(AGE_ORDER, start=1):
        expr = F.when(c == band, i) if expr is None else expr.when(c == band, i)
    return expr


def dispersion_ordered(survey: DataFrame) -> DataFrame:
    return (dispersion(survey)
            .withColumn("ord", age_order_key("Age_group"))
            .orderBy(F.asc_nulls_last("ord"), "Sex"))


def cv_pivot(survey: DataFrame, sexes=("Females", "Males")) -> DataFrame:
    """Age group x sex table of CV (one value per cell by construction); all values that are not
    among ``sexes`` (null included) are measured together in the column ``Other``."""
    sex = F.when(F.col("Sex").isin(list(sexes)), F.col("Sex")).otherwise("Other")
    return (_dispersion_raw(survey.withColumn("Sex", sex))
            .groupBy("Age_group")
            .pivot("Sex", [*sexes, "Other"])
            .agg(_r6(F.max("cv")))
            .orderBy(age_order_key("Age_group")))


def quartiles(survey: DataFrame) -> DataFrame:
    """Exact quartiles per age group (distributed counting, see
    ``operators.quantiles``)."""
    q = exact_quantiles(hearing_loss(survey).select("Age_group", "VALUE"), ["Age_group"], "VALUE",
                        {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return q.orderBy(age_from("Age_group"))


def quartiles_approx(survey: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The application's form: ``percentile_approx`` (a mergeable sketch per
    group and task; its size grows with ``accuracy``)."""
    q = F.percentile_approx("VALUE", [0.25, 0.5, 0.75], accuracy)
    return (hearing_loss(survey)
            .groupBy("Age_group")
            .agg(q.alias("_q"))
            .select("Age_group", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                    F.col("_q")[2].alias("q3"))
            .orderBy(age_from("Age_group")))


def age_bands(survey: DataFrame) -> DataFrame:
    """Every age band with its numeric lower bound (the sort key) and size."""
    return (survey.groupBy("Age_group").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("age_from", age_from("Age_group"))
            .orderBy("age_from", "Age_group"))


# ---- sign-language survey (all strings) ----

def yes_percentage(sl: DataFrame) -> DataFrame:
    yes = try_int("yes_txt")
    return sl.agg(F.sum(yes).cast("long").alias("users"),
                  F.round(F.sum(yes) / F.count(F.lit(1)) * 100, 2).alias("percentage"))


def top_regions(sl: DataFrame, k: int = 5) -> DataFrame:
    return (sl.groupBy(F.col("sha_name").alias("region_name"))
            .agg(F.sum(try_double("total_responses")).alias("total_respondents"),
                 F.sum(try_int("yes_txt")).cast("long").alias("users"))
            .orderBy(F.desc("users"), "region_name")
            .limit(k))


def region_yes_no(sl: DataFrame) -> DataFrame:
    return (sl.groupBy("sha_name")
            .agg(F.sum(try_int("yes_txt")).cast("long").alias("yes_count"),
                 F.sum(try_int("no_txt")).cast("long").alias("no_count"))
            .where((F.col("yes_count") > 0) | (F.col("no_count") > 0)))


def yes_rate_bar(sl: DataFrame) -> DataFrame:
    """Per-response bar data: group label and its % yes."""
    return sl.select(
        "sha_name", F.col("total_responses").alias("group_label"),
        F.round(try_double("yes_txt") * 100 / try_double("total_responses"), 2).alias("pct_yes"))


def cast_dirty_numbers(sl: DataFrame) -> DataFrame:
    return sl.select("sha_name", try_int("total_responses").alias("total_i"),
                     try_int("yes_txt").alias("yes_i"), try_int("no_txt").alias("no_i"))


def drop_blank_values(sl: DataFrame) -> DataFrame:
    """Blank answers become null and those rows are dropped."""
    return (sl.withColumn("yes_txt", blank_to_null("yes_txt"))
              .dropna(subset=["yes_txt"])
              .select("sha_name", "total_responses", "yes_txt", "no_txt"))
