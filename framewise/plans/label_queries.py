"""Registered queries: labels from names, dictionary joins, dataset splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset as D
from ..operators import labels as L
from ..sources import fixtures as fx
from ..sources.tables import table
from .catalog import register

_STEM = "split_part(string_split(path, '/')[-1], '.', 1)"
_TOKEN = f"split_part({_STEM}, '_', 1)"
_TOKEN_RE = f"regexp_extract({_STEM}, '^([^0-9_]+)', 1)"
_LABELLED = f"""
SELECT n.file_id, n.path, {_TOKEN} AS label_token, coalesce(d.label_id, 27) AS label_id
FROM fx_image_names n LEFT JOIN fx_labels_dim d ON d.label_name = {_TOKEN}
"""
_BUCKET = "(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT % 100)"


def _labelled(spark, sf, style="underscore"):
    return L.with_label(fx.image_names(spark, sf), fx.labels_dim(spark), style=style)


def _predict_names(spark, sf):
    ev = table(spark, sf, "events").select("event_id")
    stem = F.when(F.col("event_id") % 13 == 5, F.concat(F.lit("frame"), F.col("event_id").cast("string"))) \
            .otherwise(F.col("event_id").cast("string"))
    return ev.select(F.col("event_id").alias("file_id"),
                     F.concat(F.lit("/data/predict/"), stem, F.lit(".png")).alias("path"))


@register("label_from_filename", fixtures=("image_names", "labels_dim"),
          sql=f"SELECT file_id, label_token, label_id FROM ({_LABELLED}) t")
def label_from_filename(spark, sf):
    return _labelled(spark, sf).select("file_id", "label_token", "label_id")


@register("label_from_filename_regex", fixtures=("image_names", "labels_dim"), sql=f"""
SELECT n.file_id, {_TOKEN_RE} AS label_token, coalesce(d.label_id, 27) AS label_id
FROM fx_image_names n LEFT JOIN fx_labels_dim d ON d.label_name = {_TOKEN_RE}""")
def label_from_filename_regex(spark, sf):
    return _labelled(spark, sf, "regex").select("file_id", "label_token", "label_id")


@register("parse_sequence", sql=f"""
WITH p AS (SELECT event_id AS file_id, '/data/predict/' ||
             CASE WHEN event_id % 13 = 5 THEN 'frame' || CAST(event_id AS VARCHAR)
                  ELSE CAST(event_id AS VARCHAR) END || '.png' AS path FROM events)
SELECT file_id, {_STEM} AS stem, TRY_CAST({_STEM} AS BIGINT) AS sequence,
       TRY_CAST({_STEM} AS BIGINT) IS NULL AS is_reject FROM p""")
def parse_sequence(spark, sf):
    return L.parse_sequence(_predict_names(spark, sf)).select("file_id", "stem", "sequence", "is_reject")


@register("letter_ordinal", fixtures=("image_names", "labels_dim"), sql=f"""
SELECT file_id, label_token, ascii(label_token) - 65 AS ordinal, chr(ascii(label_token)) AS letter
FROM ({_LABELLED}) t WHERE regexp_matches(label_token, '^[A-Z]$')""")
def letter_ordinal(spark, sf):
    return L.letter_ordinals(_labelled(spark, sf)).select("file_id", "label_token", "ordinal", "letter")


@register("label_lookup", fixtures=("pred", "labels_dim"), sql="""
SELECT p.sample_id, p.predicted, coalesce(d.label_name, '?') AS label_name, coalesce(d.glyph, '?') AS glyph
FROM fx_pred p LEFT JOIN fx_labels_dim d ON d.label_id = p.predicted""")
def label_lookup(spark, sf):
    return L.lookup(fx.pred(spark, sf), fx.labels_dim(spark), "predicted") \
            .select("sample_id", "predicted", "label_name", "glyph")


@register("class_balance", fixtures=("image_names", "labels_dim"),
          sql=f"SELECT label_id, count(*) AS n FROM ({_LABELLED}) t GROUP BY label_id")
def class_balance(spark, sf):
    return L.class_balance(_labelled(spark, sf))


@register("label_close_gap", fixtures=("image_names", "labels_dim"), sql=f"""
SELECT file_id, label_id, CASE WHEN label_id > 9 THEN label_id - 1 ELSE label_id END AS label_closed
FROM ({_LABELLED}) t""")
def label_close_gap(spark, sf):
    return _labelled(spark, sf).select("file_id", "label_id",
                                       L.close_gap("label_id").alias("label_closed"))


@register("label_gap_check", fixtures=("pred",),
          sql="SELECT sample_id, actual, predicted FROM fx_pred WHERE actual = 9")
def label_gap_check(spark, sf):
    return fx.pred(spark, sf).where(F.col("actual") == 9)


@register("train_minus_test", sql="""
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def train_minus_test(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return D.minus(docs, table(spark, sf, "labels"), "doc_id")


@register("train_overlap_report", sql="""
SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def train_overlap_report(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return D.overlap(docs, table(spark, sf, "labels"), "doc_id")


_FILE = "string_split(path, '/')[-1]"


@register("train_minus_test_files", fixtures=("image_names",), sql=f"""
WITH test AS (SELECT '/data/test/' || {_FILE} AS path FROM fx_image_names WHERE file_id % 7 = 0)
SELECT file_id, {_FILE} AS name FROM fx_image_names t
WHERE NOT EXISTS (SELECT 1 FROM test WHERE string_split(test.path, '/')[-1] = string_split(t.path, '/')[-1])""")
def train_minus_test_files(spark, sf):
    """Training files whose base name is in no other folder's list of test files."""
    name = F.substring_index("path", "/", -1)
    train = fx.image_names(spark, sf)
    held = train.where(F.col("file_id") % 7 == 0).select(F.concat(F.lit("/data/test/"), name).alias("path"))
    return D.minus(train.select("file_id", name.alias("name")), held.select(name.alias("name")), "name")


@register("sample_every_nth", fixtures=("image_names", "labels_dim"), sql=f"""
SELECT file_id, folder, rn FROM (
  SELECT file_id, label_token AS folder,
         row_number() OVER (PARTITION BY label_token ORDER BY string_split(path, '/')[-1]) AS rn
  FROM ({_LABELLED}) t) WHERE (rn - 1) % 5 = 0""")
def sample_every_nth(spark, sf):
    named = _labelled(spark, sf).select(
        "file_id", F.col("label_token").alias("folder"),
        F.substring_index("path", "/", -1).alias("name"))
    return D.every_nth(named, "folder", "name", 5).select("file_id", "folder", "rn")


@register("split_train_valid", sql=f"SELECT doc_id, {_BUCKET} < 75 AS is_train FROM documents")
def split_train_valid(spark, sf):
    return D.keyed_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 75)


@register("split_train_valid_70", sql=f"SELECT doc_id, {_BUCKET} < 70 AS is_train FROM documents")
def split_train_valid_70(spark, sf):
    return D.keyed_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 70)


@register("preview_first_n", sql="SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def preview_first_n(spark, sf):
    return D.first_n(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), ["doc_id"], 10)


_PREVIEW = 0.3
_DRAWS = " + ".join(f"CASE WHEN h >= {b} THEN 1 ELSE 0 END" for b in D.poisson_bounds(_PREVIEW))


@register("preview_random", sql=f"""
WITH d AS (SELECT doc_id, lang, ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::UBIGINT AS h FROM documents),
t AS (SELECT doc_id, lang, {_DRAWS} AS times FROM d)
SELECT doc_id, lang, CAST(unnest(range(0, times)) AS INT) AS copy FROM t""")
def preview_random(spark, sf):
    """Random preview with replacement, by a hash of the key."""
    return D.random_preview(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", _PREVIEW)
