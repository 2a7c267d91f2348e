"""Registered survey queries (hearing survey and sign-language survey)."""

from __future__ import annotations

from ..operators import survey as S
from ..sources import fixtures as fx
from .catalog import register

_HL = "Categories = 'Hearing loss' AND Age_group <> 'Ages 6 to 79'"
_AGE_FROM = "TRY_CAST(substr(Age_group, 6, instr(Age_group, ' to') - 6) AS INTEGER)"
_ORD = ("CASE Age_group WHEN 'Ages 6 to 11' THEN 1 WHEN 'Ages 12 to 19' THEN 2 "
        "WHEN 'Ages 20 to 39' THEN 3 WHEN 'Ages 40 to 59' THEN 4 WHEN 'Ages 60 to 79' THEN 5 END")
_DISP = f"""
SELECT Age_group, Sex, round(var_pop(VALUE), 6) AS variance, round(stddev_pop(VALUE), 6) AS std_deviation,
       round(avg(VALUE), 6) AS mean, round(stddev_pop(VALUE) / nullif(avg(VALUE), 0), 6) AS cv
FROM fx_survey WHERE {_HL} AND VALUE IS NOT NULL
GROUP BY Age_group, Sex HAVING count(VALUE) > 1 AND var_pop(VALUE) > 0
"""


def _hearing_loss(spark, sf, *columns):
    """Hearing-loss facts with ``columns``; other dimensions are not joined."""
    return fx.survey(spark, sf, (*columns, "Categories", "VALUE"), hearing_loss=True)


@register("survey_avg_age_sex", fixtures=("survey",), sql=f"""
SELECT Age_group, Sex, round(avg(VALUE), 6) AS avg_hearing_loss, {_AGE_FROM} AS age_from
FROM fx_survey WHERE {_HL} GROUP BY Age_group, Sex""")
def survey_avg_age_sex(spark, sf):
    return S.avg_by_age_sex(_hearing_loss(spark, sf, "Age_group", "Sex"))


@register("survey_range_rate", fixtures=("survey",), sql=f"""
SELECT Age_group, round((max(VALUE) - min(VALUE)) / count(*), 6) AS rate_of_change
FROM fx_survey WHERE {_HL} GROUP BY Age_group""")
def survey_range_rate(spark, sf):
    return S.range_rate(_hearing_loss(spark, sf, "Age_group"))


@register("survey_avg_year", fixtures=("survey",), sql="""
SELECT REF_DATE, round(avg(VALUE), 6) AS avg_hearing_loss
FROM fx_survey WHERE Categories = 'Hearing loss' GROUP BY REF_DATE""")
def survey_avg_year(spark, sf):
    return S.avg_by_year(_hearing_loss(spark, sf, "REF_DATE"))


@register("survey_avg_geo", fixtures=("survey",), sql="""
SELECT GEO, round(avg(VALUE), 6) AS avg_hearing_loss
FROM fx_survey WHERE Categories = 'Hearing loss' GROUP BY GEO""")
def survey_avg_geo(spark, sf):
    return S.avg_by_geo(_hearing_loss(spark, sf, "GEO"))


@register("survey_confidence", fixtures=("survey",), sql="""
SELECT REF_DATE, round(avg(VALUE), 6) AS avg_estimate,
       round(avg(CASE WHEN Characteristics LIKE '%Low%' THEN VALUE END), 6) AS avg_low_confidence,
       round(avg(CASE WHEN Characteristics LIKE '%High%' THEN VALUE END), 6) AS avg_high_confidence
FROM fx_survey WHERE Categories = 'Hearing loss' GROUP BY REF_DATE""")
def survey_confidence(spark, sf):
    return S.confidence(_hearing_loss(spark, sf, "REF_DATE", "Characteristics"))


@register("survey_dispersion", fixtures=("survey",), sql=_DISP)
def survey_dispersion(spark, sf):
    return S.dispersion(_hearing_loss(spark, sf, "Age_group", "Sex"))


@register("survey_dispersion_ordered", fixtures=("survey",),
          sql=f"SELECT *, {_ORD} AS ord FROM ({_DISP}) d")
def survey_dispersion_ordered(spark, sf):
    return S.dispersion_ordered(_hearing_loss(spark, sf, "Age_group", "Sex"))


@register("survey_cv_pivot", fixtures=("survey",), sql=f"""
SELECT Age_group,
  round(max(CASE WHEN Sex = 'Females' THEN cv END), 6) AS Females,
  round(max(CASE WHEN Sex = 'Males' THEN cv END), 6) AS Males,
  round(max(CASE WHEN Sex = 'Other' THEN cv END), 6) AS Other
FROM (SELECT Age_group, CASE WHEN Sex IN ('Females', 'Males') THEN Sex ELSE 'Other' END AS Sex,
             stddev_pop(VALUE) / nullif(avg(VALUE), 0) AS cv FROM fx_survey
      WHERE {_HL} AND VALUE IS NOT NULL
      GROUP BY ALL HAVING count(VALUE) > 1 AND var_pop(VALUE) > 0) q GROUP BY Age_group""")
def survey_cv_pivot(spark, sf):
    return S.cv_pivot(_hearing_loss(spark, sf, "Age_group", "Sex"))


@register("survey_quartiles", fixtures=("survey",), sql=f"""
SELECT Age_group, quantile_disc(VALUE, 0.25) AS q1, quantile_disc(VALUE, 0.5) AS median,
       quantile_disc(VALUE, 0.75) AS q3
FROM fx_survey WHERE {_HL} GROUP BY Age_group""")
def survey_quartiles(spark, sf):
    return S.quartiles(_hearing_loss(spark, sf, "Age_group"))


@register("age_band_order", fixtures=("survey",), sql=f"""
SELECT Age_group, count(*) AS n_rows, {_AGE_FROM} AS age_from FROM fx_survey GROUP BY Age_group""")
def age_band_order(spark, sf):
    return S.age_bands(fx.survey(spark, sf, ("Age_group",)))


@register("yes_percentage", fixtures=("sl_users",), sql="""
SELECT CAST(sum(TRY_CAST(yes_txt AS INTEGER)) AS BIGINT) AS users,
       round((sum(TRY_CAST(yes_txt AS INTEGER)) / count(*)) * 100, 2) AS percentage FROM fx_sl_users""")
def yes_percentage(spark, sf):
    return S.yes_percentage(fx.sl_users(spark, sf))


@register("top_regions", fixtures=("sl_users",), sql="""
SELECT sha_name AS region_name, sum(TRY_CAST(total_responses AS DOUBLE)) AS total_respondents,
       CAST(sum(TRY_CAST(yes_txt AS INTEGER)) AS BIGINT) AS users
FROM fx_sl_users GROUP BY sha_name ORDER BY users DESC, region_name LIMIT 5""")
def top_regions(spark, sf):
    return S.top_regions(fx.sl_users(spark, sf))


@register("region_yes_no", fixtures=("sl_users",), sql="""
SELECT sha_name, CAST(sum(TRY_CAST(yes_txt AS INTEGER)) AS BIGINT) AS yes_count,
       CAST(sum(TRY_CAST(no_txt AS INTEGER)) AS BIGINT) AS no_count
FROM fx_sl_users GROUP BY sha_name
HAVING sum(TRY_CAST(yes_txt AS INTEGER)) > 0 OR sum(TRY_CAST(no_txt AS INTEGER)) > 0""")
def region_yes_no(spark, sf):
    return S.region_yes_no(fx.sl_users(spark, sf))


@register("yes_rate_bar", fixtures=("sl_users",), sql="""
SELECT sha_name, total_responses AS group_label,
       round(TRY_CAST(yes_txt AS DOUBLE) * 100 / TRY_CAST(total_responses AS DOUBLE), 2) AS pct_yes
FROM fx_sl_users""")
def yes_rate_bar(spark, sf):
    return S.yes_rate_bar(fx.sl_users(spark, sf))


@register("cast_dirty_numbers", fixtures=("sl_users",), sql="""
SELECT sha_name, TRY_CAST(total_responses AS INTEGER) AS total_i, TRY_CAST(yes_txt AS INTEGER) AS yes_i,
       TRY_CAST(no_txt AS INTEGER) AS no_i FROM fx_sl_users""")
def cast_dirty_numbers(spark, sf):
    return S.cast_dirty_numbers(fx.sl_users(spark, sf))


@register("drop_blank_values", fixtures=("sl_users",), sql="""
SELECT sha_name, total_responses, nullif(trim(yes_txt), '') AS yes_txt, no_txt
FROM fx_sl_users WHERE nullif(trim(yes_txt), '') IS NOT NULL""")
def drop_blank_values(spark, sf):
    return S.drop_blank_values(fx.sl_users(spark, sf))
