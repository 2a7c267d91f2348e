"""Labels from file names, the class dictionary, and label arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (file_stem, label_token, label_token_regex, letter_ordinal,
                                 ordinal_letter)
from ..schemas import UNKNOWN_LABEL


UNKNOWN_GLYPH = "?"


def with_label(names: DataFrame, dim: DataFrame, path_col: str = "path",
               style: str = "underscore") -> DataFrame:
    """Adds ``label_token`` and ``label_id`` (unknown tokens -> 27).

    ``style="underscore"`` takes the text before the first ``_`` (the
    application's rule); ``"regex"`` the text before the first digit or ``_``.
    The 29-row dictionary is broadcast.
    """
    stem = file_stem(path_col)
    tok = label_token(stem) if style == "underscore" else label_token_regex(stem)
    d = F.broadcast(dim.select(F.col("label_name").alias("label_token"),
                               F.col("label_id").alias("_lid")))
    return (names.withColumn("label_token", tok)
                 .join(d, "label_token", "left")
                 .withColumn("label_id", F.coalesce(F.col("_lid"), F.lit(UNKNOWN_LABEL)))
                 .drop("_lid"))


OTHER = "other"


def with_known_label(names: DataFrame, dim: DataFrame, path_col: str = "path") -> DataFrame:
    """Adds ``label_token``: the class name in the file name, or ``OTHER`` where it is none of ``dim``."""
    known = F.broadcast(dim.select(F.col("label_name").alias("_token"), F.col("label_name").alias("_known")))
    token = label_token(file_stem(path_col))
    return (names.withColumn("_token", token).join(known, "_token", "left")
                 .withColumn("label_token", F.coalesce("_known", F.lit(OTHER))).drop("_token", "_known"))


def parse_sequence(names: DataFrame, path_col: str = "path") -> DataFrame:
    """Numeric file stems become ``sequence``; other stems are flagged."""
    stem = file_stem(path_col)
    return (names.withColumn("stem", stem)
                 .withColumn("sequence", F.col("stem").try_cast("bigint"))
                 .withColumn("is_reject", F.col("sequence").isNull()))


def letter_ordinals(df: DataFrame, token_col: str = "label_token") -> DataFrame:
    """Single capital letters -> 0..25 and back."""
    tok = F.col(token_col)
    return (df.where(tok.rlike("^[A-Z]$"))
              .withColumn("ordinal", letter_ordinal(tok))
              .withColumn("letter", ordinal_letter(F.col("ordinal"))))


def lookup(df: DataFrame, dim: DataFrame, key_col: str) -> DataFrame:
    """Class index -> name and glyph (broadcast of the 29-row dictionary); rows of an unknown class
    stay, with ``UNKNOWN_GLYPH`` for both."""
    return lookup_as(df, dim.withColumnRenamed("label_id", key_col), key_col)


def lookup_as(df: DataFrame, dim: DataFrame, key_col: str) -> DataFrame:
    """Join an already-renamed slice of the dictionary on ``key_col`` (broadcast); its texts are
    ``UNKNOWN_GLYPH`` for keys that it lacks."""
    texts = [c for c in dim.columns if c != key_col]
    return df.join(F.broadcast(dim), key_col, "left").na.fill(UNKNOWN_GLYPH, texts)


def class_balance(df: DataFrame, label_col: str = "label_id") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def close_gap(label, gap: int = 9):
    """MNIST-style labels skip ``gap``: x > gap -> x - 1."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c > gap, c - 1).otherwise(c)
