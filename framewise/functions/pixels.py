"""Array operators over ``pixels ARRAY<INT>`` (row-major frames).

A frame stays one array column; these functions are Column -> Column
compositions of Spark's higher-order functions (``transform``, ``slice``,
``aggregate`` …), evaluated in the JVM per row with no Python round trip.
Indices are 0-based in the API; ``slice`` and ``element_at`` are 1-based
inside, ``get`` is 0-based and returns null out of range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once: an expression named inside a lambda would be
    evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def from_columns(*cols) -> Column:
    """N columns -> one array."""
    return F.array(*[_c(c) for c in cols])


def to_columns(px, n: int, prefix: str = "pixel_") -> list[Column]:
    """Array -> N int columns ``{prefix}0 …`` (null past the end)."""
    return [F.get(_c(px), i).cast("int").alias(f"{prefix}{i}") for i in range(n)]


def _size(v) -> Column:
    return F.lit(v) if isinstance(v, int) else _c(v)


def reshape(px, h, w) -> Column:
    """1-D -> h x w (array of rows); ``h``, ``w``: numbers, or columns with each frame's own size.  A
    frame of another number of values gives null."""
    h, w = _size(h), _size(w)
    return let(_c(px), lambda arr: F.when(F.size(arr) == h * w, F.transform(_upto(h), lambda r: F.slice(arr, r * w + 1, w))))


def flatten(px2d) -> Column:
    return F.flatten(_c(px2d))


def argmax(px) -> Column:
    """0-based index of the first maximum."""
    arr = _c(px)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def crop(px, w: int, y0, y1, x0, x1) -> Column:
    """``img[y0:y1, x0:x1]`` of a row-major frame of width ``w`` (2-D result).

    Bounds may be Columns (per-row boxes) or ints.
    """
    y0, y1, x0, x1 = (F.lit(v) if isinstance(v, int) else v for v in (y0, y1, x0, x1))
    return let(_c(px), lambda arr: F.transform(F.sequence(y0, y1 - 1), lambda r: F.slice(arr, r * w + x0 + 1, x1 - x0)))


def pool_mean(px, h, w, k: int = 2) -> Column:
    """k x k mean pooling of an h x w frame (numbers, or columns with each frame's own size) ->
    ceil(h/k) x ceil(w/k) doubles; where ``k`` does not divide, the cells of the last row and column
    are means of the pixels they have.  A frame of another number of values gives null."""
    h, w = _size(h), _size(w)

    def cells(arr, oh, ow, whole: bool):
        def cell(i):
            r0 = (i / ow).cast("int") * k  # output row * k
            c0 = (i % ow) * k
            first = r0 * w + c0
            total = None
            for dr in range(k):
                for dc in range(k):
                    v = F.get(arr, first + (w * dr + dc)).cast("double")
                    if not whole and (dr or dc):
                        v = F.when((r0 + dr < h) & (c0 + dc < w), v).otherwise(0.0)
                    total = v if total is None else total + v
            return total / (F.lit(k * k) if whole else F.least(F.lit(k), h - r0) * F.least(F.lit(k), w - c0))

        return F.transform(_upto(oh * ow), cell)

    def pooled(arr):
        even = cells(arr, (h / k).cast("int"), (w / k).cast("int"), True)
        odd = cells(arr, F.ceil(h / k).cast("int"), F.ceil(w / k).cast("int"), False)
        return F.when(F.size(arr) == h * w, F.when((h % k == 0) & (w % k == 0), even).otherwise(odd))

    return let(_c(px), pooled)


def nearest_resize(px, w, y0, y1, x0, x1, oh: int, ow: int) -> Column:
    """Crop box ``[y0:y1, x0:x1]`` of a width-``w`` frame, resampled to oh x ow
    by nearest neighbour (source index = start + out_index * size div out_size)."""
    def cell(arr, i):
        r = (i / ow).cast("int")
        c = i % ow
        sr = y0 + F.floor(r * (y1 - y0) / oh).cast("int")
        sc = x0 + F.floor(c * (x1 - x0) / ow).cast("int")
        return F.get(arr, sr * w + sc)

    return let(_c(px), lambda arr: F.transform(F.sequence(F.lit(0), F.lit(oh * ow - 1)), lambda i: cell(arr, i)))


def bilinear_resize(px, h, w, oh: int, ow: int) -> Column:
    """Half-pixel-centre bilinear resize of an h x w frame (``h``, ``w``: ints or per-row columns)
    to oh x ow ints, rounded half to even and kept in 0..255; null for a null frame.
    Places and weights are worked out once per output row and column, not once per cell."""
    h, w = _size(h), _size(w)

    def sources(n, on: int, stride) -> Column:
        """Per output index: offsets of its two sources, and their weights."""
        def source(i):
            at = (i.cast("double") + 0.5) * n.cast("double") / float(on) - 0.5
            return F.least(F.greatest(at, F.lit(0.0)), (n - 1).cast("double"))

        def taps(s):
            first = F.floor(s).cast("int")
            return let(first, lambda p: F.struct((p * stride).alias("a"), (F.least(p + 1, n - 1) * stride).alias("b"),
                                                 (1 - (s - p)).alias("wa"), (s - p).alias("wb")))

        return F.transform(F.sequence(F.lit(0), F.lit(on - 1)), lambda i: let(source(i), taps))

    def cell(arr, y, x):
        def at(row, column):
            return F.get(arr, y[row] + x[column]).cast("double")

        top = at("a", "a") * x["wa"] + at("a", "b") * x["wb"]
        bottom = at("b", "a") * x["wa"] + at("b", "b") * x["wb"]
        return F.least(F.greatest(F.rint(top * y["wa"] + bottom * y["wb"]).cast("int"), F.lit(0)), F.lit(255))

    def resized(arr):
        return let(sources(h, oh, w), lambda ys: let(sources(w, ow, F.lit(1)), lambda xs: F.flatten(
            F.transform(ys, lambda y: F.transform(xs, lambda x: cell(arr, y, x))))))

    return let(_c(px), lambda arr: F.when(arr.isNotNull(), resized(arr)))


def _upto(n) -> Column:
    """0 .. n - 1; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def rgb_swap(px) -> Column:
    """BGR <-> RGB on an interleaved array of any number of pixels."""
    return let(_c(px), lambda arr: F.transform(_upto(F.size(arr)), lambda k: F.get(arr, (k - k % 3) + 2 - k % 3)))


def bgr_to_grey(px) -> Column:
    """Luma 0.114 B + 0.587 G + 0.299 R of every pixel, rounded half up, in exact integer math."""
    def grey(arr, i):
        b, g, r = (F.get(arr, i * 3 + c) for c in range(3))
        return ((b * 114 + g * 587 + r * 299 + 500) / 1000).cast("int")

    return let(_c(px), lambda arr: F.transform(_upto((F.size(arr) / 3).cast("int")), lambda i: grey(arr, i)))


def scale(px, divisor: float = 255.0) -> Column:
    return F.transform(_c(px), lambda p: p / F.lit(float(divisor)))


def clip(px, lo: int = 0, hi: int = 255) -> Column:
    return F.transform(_c(px), lambda p: F.least(F.greatest(p, F.lit(lo)), F.lit(hi)))


def shift_and_clip(px, gain: int, offset: int, lo: int = 0, hi: int = 255) -> Column:
    """``clip(p * gain + offset)`` — brightness/contrast change kept in range."""
    return clip(F.transform(_c(px), lambda p: p * gain + offset), lo, hi)


def stretch(px, top: int = 255) -> Column:
    """``p * top / max`` truncated to int; an all-black frame stays as it is."""
    arr = _c(px)
    m = F.array_max(arr)
    return F.when(m > 0, F.transform(arr, lambda p: (p * float(top) / m).cast("int"))).otherwise(arr)


def one_hot(label, k: int) -> Column:
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.when(i == lab, 1).otherwise(0))


def argmax_decode(onehot) -> Column:
    """Class of a one-hot vector; null where no class is set."""
    return F.when(F.array_max(_c(onehot)) > 0, argmax(onehot))


# ---- bytes ----

def bytes_to_ints(data) -> Column:
    """BINARY -> ARRAY<INT> of its unsigned bytes: as Latin-1 text every byte is one character, whose
    code point is the byte."""
    raw = _c(data)
    chars = F.split(F.decode(raw, "ISO-8859-1"), "")
    return F.when(F.octet_length(raw) > 0, F.transform(chars, lambda c: F.ascii(c))) \
            .when(raw.isNotNull(), F.array().cast("array<int>"))


def ints_to_bytes(px) -> Column:
    """ARRAY<INT> -> BINARY, one byte a value; null if a value is null or not in 0..255.  As in
    :func:`bytes_to_ints`, every byte is a character of a Latin-1 text."""
    def packed(arr):
        whole = F.forall(arr, lambda p: F.coalesce(p.between(0, 255), F.lit(False)))
        return F.when(whole, F.encode(F.array_join(F.transform(arr, lambda p: F.char(p)), ""), "ISO-8859-1"))

    return let(_c(px), packed)


# ---- channels ----

def channel(px, c: int, channels: int = 3) -> Column:
    """One channel of an interleaved array."""
    return let(_c(px), lambda arr: F.transform(_upto((F.size(arr) / channels).cast("int")), lambda i: F.get(arr, i * channels + c)))


def interleave(*planes) -> Column:
    """Channels of one length -> interleaved array."""
    zipped = F.arrays_zip(*[_c(p).alias(f"p{i}") for i, p in enumerate(planes)])
    return F.flatten(F.transform(zipped, lambda v: F.array(*[v[f"p{i}"] for i in range(len(planes))])))


def to_bgr(px, channels) -> Column:
    """Interleaved BGR of a picture of 1 (grey), 3 or 4 (BGR and alpha) channels; null for others."""
    arr, n = _c(px), _c(channels)
    grey = F.flatten(F.transform(arr, lambda p: F.array(p, p, p)))
    opaque = let(arr, lambda a: F.transform(_upto((F.size(a) / 4).cast("int") * 3), lambda k: F.get(a, (k / 3).cast("int") * 4 + k % 3)))
    return F.when(n == 1, grey).when(n == 3, arr).when(n == 4, opaque)


# ---- widths ----

MAX_WIDTH = 20_000  # columns a wide layout may have


def longest(frames: DataFrame, px: str = "pixels") -> int:
    """Number of values of the longest frame, for layouts of one column a value: no value of any frame
    is past it.  More than ``MAX_WIDTH`` is an error, not a cut."""
    n = frames.agg(F.max(F.size(px))).first()[0] or 0
    if n > MAX_WIDTH:
        raise ValueError(f"a frame of {n} values does not fit a layout of at most {MAX_WIDTH} columns")
    return max(int(n), 0)
