"""Writing frames as PNG picture files, one file per frame, from the tasks.

Spark has no per-row binary-file writer, so ``mapInPandas`` encodes each
frame (stdlib ``zlib`` + ``struct``) and writes it through ``pyarrow.fs`` to
the shared folder (local, HDFS or object store).  File names are the frame
keys, so a retried task rewrites the same bytes: the write is idempotent.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    body = kind + data
    return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)


def encode_png(pixels, height: int, width: int, channels: int = 1) -> bytes:
    """8-bit grey (1 channel) or RGB (3 channels) PNG of row-major ``pixels``."""
    arr = np.asarray(pixels, dtype=np.uint8).reshape(height, width * channels)
    raw = b"".join(b"\x00" + row.tobytes() for row in arr)
    colour = {1: 0, 3: 2}[channels]
    ihdr = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return PNG_SIGNATURE + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def _open_fs(root: str):
    from pyarrow import fs
    if "://" in root:
        filesystem, base = fs.FileSystem.from_uri(root)
    else:
        filesystem, base = fs.LocalFileSystem(), root
    return filesystem, base.rstrip("/")


def write_pngs(frames: DataFrame, root: str, height: int | str, width: int | str, channels: int = 1,
               key: str = "frame_id", stem: str | None = None) -> DataFrame:
    """Write ``{root}/{key}.png`` per row; returns ``(key, path, n_bytes)`` rows.  ``height`` and
    ``width`` are numbers, or names of columns with each picture's own size; ``stem`` names a column
    with the file's name, unique to the row, in place of its key.
    The result is lazy — run an action on it to write."""
    out_schema = T.StructType([T.StructField(key, T.LongType()),
                               T.StructField("path", T.StringType()),
                               T.StructField("n_bytes", T.LongType())])

    def write(batches):
        filesystem, base = _open_fs(root)
        filesystem.create_dir(base, recursive=True)
        for pdf in batches:
            paths, sizes = [], []
            for name, px, h, w in zip(pdf["_stem"], pdf["pixels"], pdf["_h"], pdf["_w"]):
                data = encode_png(px, h, w, channels)
                p = f"{base}/{name}.png"
                with filesystem.open_output_stream(p) as f:
                    f.write(data)
                paths.append(p)
                sizes.append(len(data))
            yield pd.DataFrame({key: pdf[key].astype("int64"), "path": paths,
                                "n_bytes": pd.Series(sizes, dtype="int64")})

    sizes = [(F.col(v) if isinstance(v, str) else F.lit(v)).alias(n) for n, v in (("_h", height), ("_w", width))]
    name = F.col(stem or key).cast("string").alias("_stem")
    return frames.select(key, "pixels", name, *sizes).mapInPandas(write, out_schema)


def frame_key_from_path(path_col: str = "path"):
    """``…/123.png`` -> 123."""
    return F.regexp_extract(F.col(path_col), r"([0-9]+)\.png$", 1).cast("long")
