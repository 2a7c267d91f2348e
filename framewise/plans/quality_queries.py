"""Registered model-quality and burst queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds, format_stream_time, parse_stream_time
from ..operators import bursts as B
from ..operators import labels as L
from ..operators import quality as Q
from ..sources import fixtures as fx
from ..sources.tables import table
from .catalog import register

CLASSES = list(range(29))
_K = """x AS (SELECT actual AS cls, 1 AS ap, 0 AS pp, CASE WHEN actual = predicted THEN 1 ELSE 0 END AS tp FROM fx_pred
           UNION ALL SELECT predicted, 0, 1, 0 FROM fx_pred),
k AS (SELECT cls, CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(pp) AS DOUBLE) AS pp, CAST(sum(ap) AS DOUBLE) AS ap
      FROM x GROUP BY cls),
r AS (SELECT cls, tp, coalesce(tp / nullif(pp, 0), 0) AS p, coalesce(tp / nullif(ap, 0), 0) AS r,
             coalesce(2 * tp / nullif(pp + ap, 0), 0) AS f, ap FROM k)"""
_BURST = "strftime(ts, '%Y%m%d%H%M%S')"
_IDX = "CAST((epoch_us(ts) % 1000000) // 200000 AS INT)"
_NAME = f"stream_name || '_' || {_BURST} || '_' || CAST({_IDX} AS VARCHAR)"
_BAD_TEXT = "event_id % 50 = 7"


@register("confusion_matrix", fixtures=("pred",), sql=f"""
WITH cls AS (SELECT actual AS c FROM fx_pred UNION SELECT predicted FROM fx_pred)
SELECT c AS actual, {", ".join(f"count(p.sample_id) FILTER (WHERE p.predicted = {c}) AS p_{c}" for c in CLASSES)},
  count(p.sample_id) FILTER (WHERE p.predicted IS NULL OR p.predicted NOT IN ({", ".join(map(str, CLASSES))})) AS p_other
FROM cls LEFT JOIN fx_pred p ON p.actual = cls.c GROUP BY c""")
def confusion_matrix(spark, sf):
    return Q.confusion(fx.pred(spark, sf), CLASSES)


@register("classification_report", fixtures=("pred",), sql=f"""WITH {_K}
SELECT cls, round(p, 6) AS prec, round(r, 6) AS rec, round(f, 6) AS f1, CAST(ap AS BIGINT) AS support FROM r""")
def classification_report(spark, sf):
    return Q.report(fx.pred(spark, sf))


@register("classification_summary", fixtures=("pred",), sql=f"""WITH {_K}
SELECT round(sum(tp) / sum(ap), 6) AS accuracy, round(avg(p), 6) AS macro_p, round(avg(r), 6) AS macro_r,
       round(avg(f), 6) AS macro_f1, round(sum(p * ap) / sum(ap), 6) AS weighted_p,
       round(sum(r * ap) / sum(ap), 6) AS weighted_r, round(sum(f * ap) / sum(ap), 6) AS weighted_f1 FROM r""")
def classification_summary(spark, sf):
    return Q.summary(fx.pred(spark, sf))


@register("accuracy", fixtures=("pred",), sql="""
SELECT round(avg(CASE WHEN actual = predicted THEN 1 ELSE 0 END), 6) AS accuracy, count(*) AS n FROM fx_pred""")
def accuracy(spark, sf):
    return Q.accuracy(fx.pred(spark, sf))


# ---- bursts ----

@register("burst_names", fixtures=("frames",), sql=f"SELECT frame_id, {_NAME} AS burst_name FROM fx_frames")
def burst_names(spark, sf):
    return B.names(fx.frames(spark, sf))


@register("burst_parse", fixtures=("frames",), sql=f"""
SELECT frame_id, regexp_extract(n, '^(.*)_(\\d{{14}})_(\\d+)$', 1) AS stream_name,
       regexp_extract(n, '^(.*)_(\\d{{14}})_(\\d+)$', 2) AS burst,
       CAST(regexp_extract(n, '^(.*)_(\\d{{14}})_(\\d+)$', 3) AS INT) AS idx
FROM (SELECT frame_id, {_NAME} AS n FROM fx_frames) t""")
def burst_parse(spark, sf):
    return B.parse_names(B.names(fx.frames(spark, sf)))


@register("ts_format", sql="""
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts_compact, strftime(ts, '%Y%m%d %H:%M:%S') AS ts_spaced
FROM events""")
def ts_format(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return ev.select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("ts_compact"),
                     format_stream_time("ts").alias("ts_spaced"))


@register("ts_parse", sql=f"""
WITH t AS (SELECT event_id, CASE WHEN {_BAD_TEXT} THEN 'bad ' || CAST(event_id AS VARCHAR)
                                 ELSE strftime(ts, '%Y%m%d %H:%M:%S') END AS ts_text FROM events)
SELECT event_id, ts_text, CAST(epoch(try_strptime(ts_text, '%Y%m%d %H:%M:%S')) AS BIGINT) AS epoch_s FROM t""")
def ts_parse(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    text = F.when(F.expr(_BAD_TEXT), F.concat(F.lit("bad "), F.col("event_id").cast("string"))) \
            .otherwise(format_stream_time("ts"))
    return ev.select("event_id", text.alias("ts_text")) \
             .withColumn("epoch_s", epoch_seconds(parse_stream_time("ts_text")))


@register("zip_names_payloads", fixtures=("frames",), sql="""
SELECT frame_id, CAST(frame_id AS VARCHAR) || '_' || CAST(generate_subscripts(pixels, 1) - 1 AS VARCHAR) AS name,
       unnest(pixels) AS value FROM fx_frames""")
def zip_names_payloads(spark, sf):
    fr = fx.frames(spark, sf)
    names = F.transform(F.sequence(F.lit(0), F.size("pixels") - 1),
                        lambda i: F.concat_ws("_", F.col("frame_id").cast("string"), i.cast("string")))
    z = fr.select("frame_id", F.explode(F.arrays_zip(names.alias("name"), F.col("pixels").alias("value")))
                  .alias("z"))
    return z.select("frame_id", "z.name", "z.value")


@register("union_bursts", fixtures=("frames",), sql="SELECT frame_id, stream_name, label FROM fx_frames")
def union_bursts(spark, sf):
    fr = fx.frames(spark, sf).select("frame_id", "stream_name", "label")
    even = fr.where(F.col("frame_id") % 2 == 0)
    odd = fr.where(F.col("frame_id") % 2 == 1).select("label", "stream_name", "frame_id")
    return even.unionByName(odd)


@register("burst_max_letter", fixtures=("frames", "labels_dim"), sql=f"""
SELECT stream_name, {_BURST} AS burst, max(coalesce(d.glyph, '?')) AS max_letter
FROM fx_frames f LEFT JOIN fx_labels_dim d ON d.label_id = f.label GROUP BY ALL""")
def burst_max_letter(spark, sf):
    fr = B.with_burst(fx.frames(spark, sf))
    glyphs = fx.labels_dim(spark).select(F.col("label_id").alias("label"), F.col("glyph").alias("letter"))
    return B.max_letter(L.lookup_as(fr, glyphs, "label"))


@register("burst_mode_letter", fixtures=("frames",), sql=f"""
WITH n AS (SELECT stream_name, {_BURST} AS burst, label, count(*) AS n FROM fx_frames GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY stream_name, burst ORDER BY n DESC, label DESC) AS rn FROM n)
SELECT stream_name, burst, label AS mode_label, n FROM r WHERE rn = 1""")
def burst_mode_letter(spark, sf):
    return B.mode_label(fx.frames(spark, sf))


@register("frame_sample_rate", fixtures=("frames",), sql="""
SELECT frame_id, stream_name FROM (
  SELECT *, row_number() OVER (PARTITION BY stream_name, date_trunc('second', ts) ORDER BY ts, frame_id) AS rn
  FROM fx_frames) WHERE rn <= 2""")
def frame_sample_rate(spark, sf):
    return B.sample_rate(fx.frames(spark, sf), 2).select("frame_id", "stream_name")
