"""Registered model queries (rows-only where the result depends on a fitted
model), the scoring flows and the frame-preparation flows (checked in SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pixels as P
from ..operators import bursts as B
from ..operators import labels as L
from ..operators import ml as M
from ..operators import prep as PR
from ..operators import quality as Q
from ..operators import scoring as SC
from ..operators.ranking import ranked
from ..schemas import wide_schema
from ..session import fresh_path
from ..sources import files as IO
from ..sources import fixtures as fx
from ..sources import images as IMG
from ..streaming import burst_state as BS
from ..streaming import feeder
from ..streaming import queries as SQ
from .catalog import register
from .geometry_queries import _B
from .io_queries import _png_folder
from .pixel_queries import _PLANES, _duck_bilinear
from .quality_queries import _K


def _training(spark, sf):
    return M.training_frames(fx.frames(spark, sf))


def _rf_model(spark, sf):
    t = _training(spark, sf)
    return M.fit(M.random_forest(), t.where("is_train")), t


def _held_out(model, t):
    return M.scored(model, t.where("NOT is_train"))


@register("ml_random_forest")
def ml_random_forest(spark, sf):
    """Random forest (20 trees, depth 5) on /255 features; held-out rows scored."""
    model, t = _rf_model(spark, sf)
    return _held_out(model, t)


@register("ml_mlp")
def ml_mlp(spark, sf):
    """Perceptron 64-64-64-4, 95 iterations, seed 42; held-out rows scored."""
    t = _training(spark, sf)
    model = M.fit(M.mlp(), t.where("is_train"))
    return _held_out(model, t)


_TOKENS = """
SELECT file_id, coalesce(d.label_name, 'other') AS label_token FROM fx_image_names n
LEFT JOIN fx_labels_dim d ON d.label_name = split_part(split_part(string_split(path, '/')[-1], '.', 1), '_', 1)
"""


@register("ml_label_index", fixtures=("image_names", "labels_dim"), sql=f"""
WITH t AS ({_TOKENS}),
c AS (SELECT label_token, count(*) AS n FROM t GROUP BY label_token),
r AS (SELECT label_token, CAST(row_number() OVER (ORDER BY n DESC, label_token) - 1 AS DOUBLE) AS token_index FROM c)
SELECT t.file_id, t.label_token, r.token_index FROM t JOIN r USING (label_token)""")
def ml_label_index(spark, sf):
    """Labels by frequency.  Names that are none of the 29 are one class, so what the indexer brings to
    the driver has 30 names at most."""
    names = L.with_known_label(fx.image_names(spark, sf), fx.labels_dim(spark)).select("file_id", "label_token")
    model = M.label_indexer("label_token", "token_index").fit(names)
    return model.transform(names)


@register("ml_save_load", fixtures=("frames",), sql="""
SELECT frame_id, true AS agree FROM fx_frames
WHERE ('0x' || substr(md5(CAST(frame_id AS VARCHAR)), 1, 8))::UBIGINT % 100 >= 75""")
def ml_save_load(spark, sf):
    """Fit, save to the shared folder, load back: per held-out row, do both models agree?"""
    model, t = _rf_model(spark, sf)
    loaded = M.save_and_load(model, fresh_path(spark, "model-rf"))
    fitted = model.transform(t.where("NOT is_train")).select("frame_id", "pixels", F.col("prediction").alias("fitted"))
    return loaded.transform(fitted).select("frame_id", (F.col("fitted") == F.col("prediction")).alias("agree"))


@register("ml_evaluate")
def ml_evaluate(spark, sf):
    """Per-class report of the fitted forest on the held-out rows."""
    model, t = _rf_model(spark, sf)
    held = _held_out(model, t).withColumn("target", F.col("target").cast("int"))
    return Q.report(held, actual="target", predicted="prediction")


# Oracle text of operators.scoring.linear_class: 29 integer scores, smallest class of the highest.
def _duck_linear(px: str) -> str:
    scores = (f"list_transform(range(0, 29), lambda k: list_sum(list_transform(range(0, len({px})), lambda i: "
              f"CAST({px}[i + 1] AS BIGINT) * ((i * (2 * k + 1) + 7 * k) % 23 - 11))))")
    return f"CAST(list_position({scores}, list_max({scores})) - 1 AS INT)"


_SCORED = f"""SELECT s.*, coalesce(d.glyph, '?') AS glyph FROM (
  SELECT frame_id, stream_name, ts, label, {_duck_linear("pixels")} AS prediction FROM fx_frames) s
LEFT JOIN fx_labels_dim d ON d.label_id = s.prediction"""


def _lettered(spark, scored):
    """Scored rows with the class glyph (29-row dictionary, broadcast)."""
    glyphs = fx.labels_dim(spark).select(F.col("label_id").alias("prediction"), "glyph")
    return L.lookup_as(scored, glyphs, "prediction")


def _scored_frames(spark, sf):
    return _lettered(spark, SC.linear_model().transform(fx.frames(spark, sf)))


@register("predict_batch", fixtures=("frames", "labels_dim"), sql=f"SELECT frame_id, prediction, glyph FROM ({_SCORED}) t")
def predict_batch(spark, sf):
    """Score every frame and attach the class name (broadcast dictionary)."""
    return _scored_frames(spark, sf).select("frame_id", "prediction", "glyph")


@register("udf_predict_batch", fixtures=("frames", "labels_dim"), sql=f"SELECT frame_id, prediction FROM ({_SCORED}) t")
def udf_predict_batch(spark, sf):
    """An outside numpy model served through ``predict_batch_udf`` (Arrow
    batches, one model build per worker)."""
    score = SC.served_udf(n_pixels=P.longest(fx.frames(spark, sf)))
    return fx.frames(spark, sf).select("frame_id", score(F.col("pixels").cast("array<double>")).alias("prediction"))


@register("pred_truth_pairs", fixtures=("frames", "labels_dim"), sql=f"""
SELECT frame_id, label AS actual, prediction, label = prediction AS hit FROM ({_SCORED}) t""")
def pred_truth_pairs(spark, sf):
    """Predictions paired with the true labels by key, not by row position."""
    truth = fx.frames(spark, sf).select("frame_id", F.col("label").alias("actual"))
    pairs = truth.join(_scored_frames(spark, sf).select("frame_id", "prediction"), "frame_id")
    return pairs.withColumn("hit", F.col("actual") == F.col("prediction"))


@register("scored_report", fixtures=("frames", "labels_dim"), sql=f"""
WITH fx_pred AS (SELECT label AS actual, prediction AS predicted FROM ({_SCORED}) t), {_K}
SELECT cls, round(p, 6) AS prec, round(r, 6) AS rec, round(f, 6) AS f1, CAST(ap AS BIGINT) AS support FROM r""")
def scored_report(spark, sf):
    """A model's evaluation as a report per class: frames scored, paired with their labels by key, and
    written once, so that every metric is over the same predictions."""
    pairs = pred_truth_pairs(spark, sf).select("frame_id", "actual", F.col("prediction").alias("predicted"))
    return Q.report(spark.read.parquet(IO.write_parquet(pairs, fresh_path(spark, "predictions"))))


@register("predict_transcript", fixtures=("frames", "labels_dim"), sql=f"""
SELECT stream_name, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute,
       string_agg(glyph, '' ORDER BY frame_id) AS line FROM ({_SCORED}) t GROUP BY ALL""")
def predict_transcript(spark, sf):
    """Predicted letters joined into one line per stream and minute, in frame
    order."""
    return transcripts(_scored_frames(spark, sf))


TRANSCRIPT_BLOCK = 64


def transcripts(lettered):
    """One line per stream and minute, letters in frame order.

    Two levels, so a crowded minute never orders all its letters in one
    task: letters are first joined per block of ``TRANSCRIPT_BLOCK`` frame
    ids (blocks hash to many tasks), then the block strings are joined in
    block order.  The result equals a single ordered ``listagg``."""
    minute = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm")
    blocks = (lettered.groupBy("stream_name", minute.alias("minute"),
                               F.floor(F.col("frame_id") / TRANSCRIPT_BLOCK).alias("_blk"))
                      .agg(F.expr("listagg(glyph, '') WITHIN GROUP (ORDER BY frame_id)").alias("_part")))
    return (blocks.groupBy("stream_name", "minute")
                  .agg(F.expr("listagg(_part, '') WITHIN GROUP (ORDER BY _blk)").alias("line")))


@register("transcript_from_labels", fixtures=("frames", "labels_dim"), sql="""
SELECT stream_name, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute,
       string_agg(coalesce(glyph, '?'), '' ORDER BY frame_id) AS line
FROM fx_frames f LEFT JOIN fx_labels_dim d ON d.label_id = f.label GROUP BY ALL""")
def transcript_from_labels(spark, sf):
    """The join-and-concatenate step of the transcript on the true labels."""
    fr = fx.frames(spark, sf).select("frame_id", "stream_name", "ts", F.col("label").alias("label_id"))
    return transcripts(L.lookup(fr, fx.labels_dim(spark), "label_id"))


PIECE = 4096  # letters of a piece of a line


def line_pieces(lettered, keys=("stream_name", "minute"), order="frame_id", piece=PIECE):
    """The lines of :func:`transcripts` as ordered pieces of at most ``piece`` letters (``keys``,
    ``piece_no``, ``text``): letters get their place in the line over ranges, so no task holds a line,
    however long.  The pieces of a line, joined in order, are the line."""
    placed = ranked(lettered.select(*keys, order, "glyph"), list(keys), [order], "place")
    number = F.floor((F.col("place") - 1) / piece).cast("long").alias("piece_no")
    return placed.groupBy(*keys, number).agg(F.expr("listagg(glyph, '') WITHIN GROUP (ORDER BY place)").alias("text"))


@register("transcript_pieces", fixtures=("frames", "labels_dim"), sql="""
WITH l AS (SELECT stream_name, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, frame_id, coalesce(glyph, '?') AS glyph
           FROM fx_frames f LEFT JOIN fx_labels_dim d ON d.label_id = f.label),
p AS (SELECT *, (row_number() OVER (PARTITION BY stream_name, minute ORDER BY frame_id) - 1) // 16 AS piece_no FROM l)
SELECT stream_name, minute, piece_no, string_agg(glyph, '' ORDER BY frame_id) AS text FROM p GROUP BY ALL""")
def transcript_pieces(spark, sf):
    """The transcript in pieces of 16 letters."""
    fr = fx.frames(spark, sf).select("frame_id", "stream_name", F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm").alias("minute"), F.col("label").alias("label_id"))
    return line_pieces(L.lookup(fr, fx.labels_dim(spark), "label_id"), piece=16)


def _burst_letters(spark, root, max_files=None):
    """The burst file stream, scored and lettered."""
    stream = SQ.burst_stream(spark, root, max_files).withColumnRenamed("Pixels", "pixels")
    return _lettered(spark, SC.linear_model().transform(stream))


@register("stream_predict", fixtures=("frames", "labels_dim"), sql=f"""
SELECT frame_id, concat(stream_name, '_', strftime(ts, '%Y%m%d%H%M%S')) AS burst,
       strftime(ts, '%Y%m%d %H:%M:%S') AS time, prediction, glyph FROM ({_SCORED}) t""")
def stream_predict(spark, sf):
    """The model applied to the burst file stream, with file name, time and letter."""
    root = feeder.write_bursts(fx.frames(spark, sf), fresh_path(spark, "bursts-in"))
    rows = _burst_letters(spark, root, max_files=BATCH_FILES).select(
        "frame_id", F.col("Filename").alias("burst"), F.col("Time").alias("time"), "prediction", "glyph")
    return spark.read.schema(rows.schema).parquet(SQ.run_append(rows, kind="stream-predict"))


BATCH_FILES = 256  # burst files a micro-batch takes


def burst_letters(spark, root, max_files=BATCH_FILES, out=None, checkpoint=None):
    """Run the stream flow over the burst files below ``root``: score, letter, event time from the
    ``Time`` text, greatest letter per burst file name, update mode with an upsert per batch.
    Returns the sink folder; with ``out``/``checkpoint`` of an earlier run it resumes that one."""
    best = SQ.max_letter_per_key(_burst_letters(spark, root, max_files), "Filename", "glyph", "timestamp")
    return SQ.run_update(best.withColumnRenamed("Filename", "burst"), ["burst"], "burst-letters", out, checkpoint)


@register("stream_burst_letters", fixtures=("frames", "labels_dim"), sql=f"""
SELECT concat(stream_name, '_', strftime(ts, '%Y%m%d%H%M%S')) AS burst, max(glyph) AS max_letter
FROM ({_SCORED}) t GROUP BY ALL""")
def stream_burst_letters(spark, sf):
    """The whole stream flow: burst files -> score -> letter -> greatest letter per burst."""
    root = feeder.write_bursts(fx.frames(spark, sf), fresh_path(spark, "bursts-in"))
    return SQ.latest_per_key(spark, burst_letters(spark, root), ["burst"])


def burst_letters_evicting(spark, root, max_files=BATCH_FILES, out=None, checkpoint=None):
    """:func:`burst_letters` with a state that ends: a burst is dropped once the watermark has passed
    its last frame."""
    letters = BS.greatest_letters(_burst_letters(spark, root, max_files), "Filename", "glyph", "timestamp")
    with SQ.state_store(spark, *BS.STATE_STORE):
        return SQ.run_update(letters, ["burst"], "burst-letters", out, checkpoint)


@register("stream_burst_letters_evict", fixtures=("frames", "labels_dim"), sql=f"""
SELECT concat(stream_name, '_', strftime(ts, '%Y%m%d%H%M%S')) AS burst, max(glyph) AS max_letter
FROM ({_SCORED}) t GROUP BY ALL""")
def stream_burst_letters_evict(spark, sf):
    """The whole stream flow with event-time timers that drop finished bursts from the state."""
    root = feeder.write_bursts(fx.frames(spark, sf), fresh_path(spark, "bursts-in"))
    return SQ.latest_per_key(spark, burst_letters_evicting(spark, root), ["burst"])


# ---- preparation flows ----

_GRID = f"""WITH {_B},
q AS (SELECT frame_id, cx, cy, md, x0 + dx AS sx0, x1 - dx AS sx1, y0 + CAST(floor(dy / 2.0) AS INT) AS sy0,
             y1 - CAST(floor(dy / 2.0) AS INT) AS sy1 FROM g),
gr AS (SELECT frame_id, cx, cy, md, (sx0 * 8) // 640 AS gx0, (sy0 * 8) // 480 AS gy0,
              least(greatest((sx0 * 8) // 640 + 1, CAST(ceil(sx1 * 8 / 640::DOUBLE) AS INT)), 8) AS gx1,
              least(greatest((sy0 * 8) // 480 + 1, CAST(ceil(sy1 * 8 / 480::DOUBLE) AS INT)), 8) AS gy1 FROM q)"""


@register("frame_prep_pipeline", fixtures=("landmarks", "frames"), sql=f"""{_GRID}
SELECT f.frame_id, list_transform(range(0, 16), lambda i:
  f.pixels[(gy0 + (i // 4) * (gy1 - gy0) // 4) * 8 + gx0 + (i % 4) * (gx1 - gx0) // 4 + 1]) AS pixels, false AS is_reject
FROM fx_frames f JOIN gr ON f.frame_id = gr.frame_id""")
def frame_prep_pipeline(spark, sf):
    return PR.hand_crops(fx.frames(spark, sf), fx.landmarks(spark, sf))


@register("picture_prep_pipeline", fixtures=("landmarks", "frames", "pictures"), sql=f"""WITH {_B},
q AS (SELECT frame_id, x0 + dx AS sx0, x1 - dx AS sx1, y0 + CAST(floor(dy / 2.0) AS INT) AS sy0,
             y1 - CAST(floor(dy / 2.0) AS INT) AS sy1 FROM g),
box AS (SELECT p.*, sx1, sy1, greatest(0, least((sx0 * p.width) // 640, p.width - 1)) AS gx0,
             greatest(0, least((sy0 * p.height) // 480, p.height - 1)) AS gy0
      FROM q JOIN fx_pictures p ON p.frame_id = q.frame_id),
own AS (SELECT frame_id, width AS pw, bgr, gx0, gy0,
             least(greatest(gx0 + 1, CAST(ceil(sx1 * width / 640::DOUBLE) AS INT)), width) - gx0 AS width,
             least(greatest(gy0 + 1, CAST(ceil(sy1 * height / 480::DOUBLE) AS INT)), height) - gy0 AS height FROM box),
cut AS (SELECT frame_id, ch, width, height, list_transform(range(0, width * height),
             lambda k: bgr[((gy0 + k // width) * pw + gx0 + k % width) * 3 + ch + 1]) AS pixels FROM own, range(0, 3) t(ch)),
small AS (SELECT frame_id, ch, {_duck_bilinear("height", "width", PR.OUT, PR.OUT)} AS px FROM cut)
SELECT b.frame_id, list_transform(range(0, 16), lambda i:
  CAST((b.px[i + 1] * 114 + n.px[i + 1] * 587 + r.px[i + 1] * 299 + 500) // 1000 AS INT)) AS pixels, false AS is_reject
FROM small b JOIN small n ON n.frame_id = b.frame_id JOIN small r ON r.frame_id = b.frame_id
WHERE b.ch = 0 AND n.ch = 1 AND r.ch = 2""")
def picture_prep_pipeline(spark, sf):
    """Picture files -> decode -> hand box -> crop -> bilinear resize -> grey, keyed by the file name."""
    decoded = IO.image_pixels(IO.read_images(spark, _png_folder(spark, sf))) \
                .select(IMG.frame_key_from_path("origin").alias("frame_id"), "height", "width",
                        F.col("pixels").alias("bgr"))
    return PR.picture_crops(decoded, fx.landmarks(spark, sf))


_SIDE = 28
_HAND_28 = f"""WITH {_B},
q AS (SELECT frame_id, x0 + dx AS sx0, x1 - dx AS sx1, y0 + CAST(floor(dy / 2.0) AS INT) AS sy0,
             y1 - CAST(floor(dy / 2.0) AS INT) AS sy1 FROM g),
box AS (SELECT p.*, sx1, sy1, greatest(0, least((sx0 * p.width) // 640, p.width - 1)) AS gx0,
             greatest(0, least((sy0 * p.height) // 480, p.height - 1)) AS gy0
      FROM q JOIN fx_pictures p ON p.frame_id = q.frame_id),
own AS (SELECT frame_id, width AS pw, bgr, gx0, gy0,
             least(greatest(gx0 + 1, CAST(ceil(sx1 * width / 640::DOUBLE) AS INT)), width) - gx0 AS width,
             least(greatest(gy0 + 1, CAST(ceil(sy1 * height / 480::DOUBLE) AS INT)), height) - gy0 AS height FROM box),
cut AS (SELECT frame_id, ch, width, height, list_transform(range(0, width * height),
             lambda k: bgr[((gy0 + k // width) * pw + gx0 + k % width) * 3 + ch + 1]) AS pixels FROM own, range(0, 3) t(ch)),
small AS (SELECT frame_id, ch, {_duck_bilinear("height", "width", _SIDE, _SIDE)} AS px FROM cut),
crops AS (SELECT b.frame_id, list_transform(range(0, {_SIDE * _SIDE}), lambda i:
  CAST((b.px[i + 1] * 114 + n.px[i + 1] * 587 + r.px[i + 1] * 299 + 500) // 1000 AS INT)) AS px
FROM small b JOIN small n ON n.frame_id = b.frame_id JOIN small r ON r.frame_id = b.frame_id
WHERE b.ch = 0 AND n.ch = 1 AND r.ch = 2)"""


def _decoded(spark, folder):
    """Picture files -> ``path``, ``height``, ``width``, ``bgr``, in the JVM."""
    return IO.image_pixels(IO.read_images(spark, folder)).select(
        F.col("origin").alias("path"), "height", "width", F.col("pixels").alias("bgr"))


@register("picture_letters", fixtures=("landmarks", "frames", "pictures", "labels_dim"), sql=f"""{_HAND_28},
s AS (SELECT frame_id, {_duck_linear("px")} AS prediction FROM crops),
l AS (SELECT frame_id, coalesce(glyph, '?') AS glyph, (row_number() OVER (ORDER BY frame_id) - 1) // 64 AS piece_no
      FROM s LEFT JOIN fx_labels_dim d ON d.label_id = s.prediction)
SELECT 'all' AS run, piece_no, string_agg(glyph, '' ORDER BY frame_id) AS text FROM l GROUP BY ALL""")
def picture_letters(spark, sf):
    """The whole batch conversion: picture files -> decode -> hand box -> crop -> 28 x 28 -> grey ->
    model -> letter -> the ordered line of the run, in pieces."""
    decoded = L.parse_sequence(_decoded(spark, _png_folder(spark, sf))).withColumn("frame_id", F.col("sequence"))
    crops = PR.picture_crops(decoded, fx.landmarks(spark, sf), out=_SIDE)
    lettered = _lettered(spark, SC.linear_model().transform(crops)).withColumn("run", F.lit("all"))
    return line_pieces(lettered, keys=("run",), piece=64)


@register("dataset_csv", fixtures=("frames", "pictures", "labels_dim"), sql=f"""WITH {_PLANES},
named AS (SELECT frame_id, CASE WHEN frame_id % 13 = 5 OR d.label_id IS NULL THEN 27 ELSE d.label_id END AS label, grey
          FROM bytes b LEFT JOIN fx_labels_dim d ON d.label_id = b.label)
SELECT label, {", ".join(f"grey[{i + 1}] AS pixel_{i}" for i in range(_SIDE * _SIDE))} FROM named""")
def dataset_csv(spark, sf):
    """The training set from picture files named by their class: decode -> resize 28 x 28 -> grey -> label
    of the file name -> wide CSV, read back with its schema."""
    pictures = fx.pictures(spark, sf).withColumnRenamed("label", "label_id")
    named = pictures.join(F.broadcast(fx.labels_dim(spark).select("label_id", "label_name")), "label_id", "left") \
                    .withColumn("stem", F.concat_ws("_", F.when(F.col("frame_id") % 13 == 5, F.lit("junk"))
                                                    .otherwise(F.coalesce("label_name", F.lit("none"))), "frame_id"))
    root = fresh_path(spark, "dataset-png")
    rgb = named.select("frame_id", "stem", "height", "width", P.rgb_swap("bgr").alias("pixels"))
    IMG.write_pngs(rgb, root, "height", "width", channels=3, stem="stem").write.format("noop").mode("overwrite").save()
    rows = L.with_label(_decoded(spark, root), fx.labels_dim(spark)).select(F.col("label_id").alias("label"), "height", "width", "bgr")
    return IO.read_csv_typed(spark, IO.write_csv(PR.dataset_rows(rows, _SIDE), fresh_path(spark, "dataset-28")),
                             wide_schema("label", _SIDE * _SIDE, prefix="pixel_"))


_CROPS = f"""{_GRID},
crops AS (SELECT f.frame_id, stream_name, ts, list_transform(range(0, 16), lambda i:
  f.pixels[(gy0 + (i // 4) * (gy1 - gy0) // 4) * 8 + gx0 + (i % 4) * (gx1 - gx0) // 4 + 1]) AS px
FROM fx_frames f JOIN gr ON f.frame_id = gr.frame_id)"""


@register("flagship_letters", fixtures=("landmarks", "frames", "labels_dim"), sql=f"""{_CROPS},
s AS (SELECT stream_name, ts, {_duck_linear("px")} AS prediction FROM crops),
n AS (SELECT stream_name, strftime(ts, '%Y%m%d%H%M%S') AS burst, coalesce(glyph, '?') AS letter, count(*) AS n
      FROM s LEFT JOIN fx_labels_dim d ON d.label_id = s.prediction GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY stream_name, burst ORDER BY n DESC, letter DESC) AS rn FROM n)
SELECT stream_name, burst, letter, n FROM r WHERE rn = 1""")
def flagship_letters(spark, sf):
    """The whole batch flow: landmarks -> hand box -> crop -> 4x4 resample ->
    model score -> letter -> most frequent letter of each stream second.
    The frames are scanned and joined once for their pixels, stream and time."""
    crops = PR.hand_crops(fx.frames(spark, sf), fx.landmarks(spark, sf), keep=("stream_name", "ts"))
    lettered = _lettered(spark, SC.linear_model().transform(crops)).withColumnRenamed("glyph", "letter")
    return B.mode_label(lettered, "letter").withColumnRenamed("mode_label", "letter")


@register("debug_stage_tee", fixtures=("landmarks", "frames"), sql=f"""{_GRID}
SELECT 'centre' AS stage, frame_id, [cx::DOUBLE, cy::DOUBLE, round(md, 6)] AS "values" FROM gr
UNION ALL
SELECT 'box', frame_id, [gx0::DOUBLE, gy0::DOUBLE, gx1::DOUBLE, gy1::DOUBLE] FROM gr
UNION ALL
SELECT 'crop', f.frame_id, list_transform(range(0, 16), lambda i:
  f.pixels[(gy0 + (i // 4) * (gy1 - gy0) // 4) * 8 + gx0 + (i % 4) * (gx1 - gx0) // 4 + 1]::DOUBLE)
FROM fx_frames f JOIN gr ON f.frame_id = gr.frame_id""")
def debug_stage_tee(spark, sf):
    return PR.debug_tee(fx.frames(spark, sf), fx.landmarks(spark, sf)).select("stage", "frame_id", "values")


_GREY = ("list_transform(range(0, len(bgr) // 3), lambda i: CAST((bgr[i * 3 + 1] * 114 + bgr[i * 3 + 2] * 587 "
         "+ bgr[i * 3 + 3] * 299 + 500) // 1000 AS INT))")


@register("training_prep_pipeline", fixtures=("frames", "pictures"), sql=f"""
SELECT frame_id, label, {_duck_bilinear("height", "width", PR.OUT, PR.OUT)} AS pixels
FROM (SELECT frame_id, label, height, width, {_GREY} AS pixels FROM fx_pictures) t""")
def training_prep_pipeline(spark, sf):
    return PR.training_rows(fx.pictures(spark, sf))
