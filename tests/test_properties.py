"""Property checks of the column operators, geometry and file formats."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewise.functions import pixels as P
from framewise.operators import frames as FR
from framewise.operators import geometry as G
from framewise.sources import files as IO
from framewise.sources import fixtures as fx
from framewise.sources import images as IMG
from framewise.session import fresh_path


def test_reshape_then_flatten_is_identity(spark, sf_dir):
    fr = fx.frames(spark, sf_dir)
    bad = fr.where(P.flatten(P.reshape("pixels", 8, 8)) != F.col("pixels")).count()
    assert bad == 0


def test_explode_then_regroup_is_identity(spark, sf_dir):
    fr = fx.frames(spark, sf_dir)
    flat = FR.explode_pixels(fr).select((F.col("frame_id") * 64 + F.col("pos")).alias("gpos"), "pixel")
    back = FR.regroup(flat, 64).withColumnRenamed("chunk_id", "frame_id")
    assert back.join(fr.select("frame_id", "pixels"), ["frame_id", "pixels"], "left_anti").count() == 0
    assert back.count() == fr.count()


def test_one_hot_then_argmax_is_identity(spark, sf_dir):
    fr = fx.frames(spark, sf_dir)
    bad = fr.where(P.argmax(P.one_hot("label", 29)) != F.col("label")).count()
    assert bad == 0


def test_crop_boxes_inside_frame_and_square(spark, sf_dir):
    b = G.boxes_for_frames(fx.frames(spark, sf_dir), fx.landmarks(spark, sf_dir))
    outside = b.where((F.col("x0") < 0) | (F.col("y0") < 0) | (F.col("x1") > 640) | (F.col("y1") > 480))
    assert outside.count() == 0
    w, h = F.col("sx1") - F.col("sx0"), F.col("sy1") - F.col("sy0")
    # fixed trimming: square up to the one pixel lost to odd differences
    assert b.where(F.abs(w - h) > 1).count() == 0
    compat = G.square_box(b.select("frame_id", "x0", "y0", "x1", "y1"), exact_compat=True)
    tall = compat.where((F.col("y1") - F.col("y0")) > (F.col("x1") - F.col("x0")))
    # the application's rule trims tall boxes by the full difference on both sides
    assert tall.where((F.col("sy1") - F.col("sy0")) != 2 * (F.col("x1") - F.col("x0"))
                      - (F.col("y1") - F.col("y0"))).count() == 0


def test_no_hand_frames_get_picture_centre(spark, sf_dir):
    b = G.boxes_for_frames(fx.frames(spark, sf_dir), fx.landmarks(spark, sf_dir)).where("no_hand")
    rows = b.select("frame_id", "cx", "cy", "max_dist").collect()
    assert rows and all(r.cx == 320 and r.cy == 240 and r.max_dist == 640.0 for r in rows)
    assert all(r.frame_id % 10 == 9 for r in rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=48, max_size=48))
def test_grey_matches_integer_luma(spark, px):
    df = spark.createDataFrame([(px,)], "pixels array<int>")
    got = df.select(P.bgr_to_grey("pixels").alias("g")).first().g
    a = np.array(px).reshape(16, 3)
    want = ((a[:, 0] * 114 + a[:, 1] * 587 + a[:, 2] * 299 + 500) // 1000).tolist()
    assert got == want


def _bilinear(px, h, w, oh, ow):
    img = np.array(px, dtype=float).reshape(h, w)
    sy = np.clip((np.arange(oh) + 0.5) * h / oh - 0.5, 0, h - 1)
    sx = np.clip((np.arange(ow) + 0.5) * w / ow - 0.5, 0, w - 1)
    y0, x0 = np.floor(sy).astype(int), np.floor(sx).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (sy - y0)[:, None], (sx - x0)[None, :]
    top = img[y0][:, x0] * (1 - fx) + img[y0][:, x1] * fx
    bottom = img[y1][:, x0] * (1 - fx) + img[y1][:, x1] * fx
    return np.clip(np.rint(top * (1 - fy) + bottom * fy), 0, 255).astype(int).ravel().tolist()


def test_bilinear_resize_takes_any_shape(spark):
    rng = np.random.default_rng(5)
    rows = [(h, w, rng.integers(0, 256, h * w).tolist()) for h, w in [(8, 8), (7, 7), (1, 9), (4, 16), (3, 2)]]
    df = spark.createDataFrame([*rows, (8, 8, None), (8, 8, [77] * 64)], "h int, w int, px array<int>")
    got = df.select("h", "w", "px", P.bilinear_resize("px", "h", "w", 5, 4).alias("r")).collect()
    for r in got:
        assert r.r == (None if r.px is None else _bilinear(r.px, r.h, r.w, 5, 4))


def test_odd_inputs_keep_every_row(spark):
    from framewise.operators import labels as L
    from framewise.operators import quality as Q
    from framewise.operators import survey as S
    pairs = spark.createDataFrame([(1, 1), (1, 12), (2, 40), (2, None)], "actual int, predicted int")
    m = {r.actual: r.asDict() for r in Q.confusion(pairs, list(range(29))).collect()}
    assert m[1]["p_1"] == 1 and m[1]["p_12"] == 1 and m[2]["p_other"] == 2
    named = L.lookup(pairs, fx.labels_dim(spark), "predicted").collect()
    assert len(named) == 4 and sorted(r.glyph for r in named) == ["?", "?", "B", "M"]
    one = spark.createDataFrame([(28,), (29,)], "label int").select("label", P.one_hot("label", 29).alias("v"))
    assert [r.d for r in one.orderBy("label").select(P.argmax_decode("v").alias("d")).collect()] == [28, None]
    facts = spark.createDataFrame([("Ages 6 to 11", s, "Hearing loss", float(v)) for s in ("Females", "Both sexes")
                                   for v in (1, 3)], "Age_group string, Sex string, Categories string, VALUE double")
    assert [tuple(r) for r in S.cv_pivot(facts).collect()] == [("Ages 6 to 11", 0.5, None, 0.5)]
    pooled = spark.createDataFrame([(list(range(9)),)], "px array<int>").select(P.pool_mean("px", 3, 3, 2).alias("p"))
    assert pooled.first().p == [2.0, 3.5, 6.5, 8.0]


def test_broken_picture_is_flagged(spark):
    root = fresh_path(spark, "broken")
    spark.createDataFrame([("not a picture",)], "value string").coalesce(1).write.text(root)
    assert [r.is_reject for r in IO.image_pixels(IO.read_images(spark, root)).collect()] == [True]


def test_png_golden_rgb_decodes_to_bgr(spark):
    """4x6, 5x6, 6x6 RGB pictures with value ((y*w+x)*3+c) % 256."""
    root = fresh_path(spark, "golden")
    import pyarrow.fs as pafs
    fs = pafs.LocalFileSystem()
    fs.create_dir(root)
    for h, w in [(4, 6), (5, 6), (6, 6)]:
        px = [((y * w + x) * 3 + c) % 256 for y in range(h) for x in range(w) for c in range(3)]
        with fs.open_output_stream(f"{root}/{h}x{w}.png") as f:
            f.write(IMG.encode_png(px, h, w, channels=3))
    imgs = IO.image_pixels(IO.read_images(spark, root)).orderBy("height").collect()
    assert [(r.height, r.width, r.channels) for r in imgs] == [(4, 6, 3), (5, 6, 3), (6, 6, 3)]
    assert imgs[0].pixels[:6] == [2, 1, 0, 5, 4, 3]
    files = IO.read_binary_files(spark, root, "*.png").collect()
    assert len(files) == 3 and all(f.length > 50 for f in files)


def test_csv_variants_roundtrip(spark, sf_dir):
    pred = fx.pred(spark, sf_dir)
    path = IO.write_csv(pred, fresh_path(spark, "csvt"))
    strings = IO.read_csv_strings(spark, path)
    assert dict(strings.dtypes) == {"sample_id": "string", "actual": "string", "predicted": "string"}
    inferred = IO.read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["actual"] == "int"
    bare = IO.write_csv(pred, fresh_path(spark, "csvh"), header=False)
    back = IO.read_csv_headerless(spark, bare, ["sample_id", "actual", "predicted"])
    assert back.subtract(pred.select(F.col("sample_id").cast("int"), "actual", "predicted")).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=64, max_size=64),
       st.integers(0, 6), st.integers(1, 8), st.integers(0, 6), st.integers(1, 8))
def test_pixel_ops_match_numpy(spark, px, y0, h, x0, w):
    y1, x1 = min(8, y0 + h), min(8, x0 + w)
    a = np.array(px).reshape(8, 8)
    df = spark.createDataFrame([(px,)], "pixels array<int>")
    r = df.select(
        P.crop("pixels", 8, y0, y1, x0, x1).alias("crop"),
        P.pool_mean("pixels", 8, 8, 2).alias("pool"),
        P.rgb_swap(F.slice("pixels", 1, 63)).alias("rgb"),
        P.stretch("pixels").alias("stretch"),
        P.argmax("pixels").alias("am"),
        P.nearest_resize("pixels", 8, F.lit(y0), F.lit(y1), F.lit(x0), F.lit(x1), 4, 4).alias("nn"),
    ).first()
    assert r.crop == a[y0:y1, x0:x1].tolist()
    assert r.pool == a.reshape(4, 2, 4, 2).mean(axis=(1, 3)).ravel().tolist()
    bgr = np.array(px[:63]).reshape(21, 3)
    assert r.rgb == bgr[:, ::-1].ravel().tolist()
    m = a.max()
    assert r.stretch == (px if m == 0 else (a.ravel() * 255.0 / m).astype(int).tolist())
    assert r.am == int(np.argmax(a.ravel()))
    rows = [y0 + (i * (y1 - y0)) // 4 for i in range(4)]
    cols = [x0 + (j * (x1 - x0)) // 4 for j in range(4)]
    assert r.nn == a[np.ix_(rows, cols)].ravel().tolist()
