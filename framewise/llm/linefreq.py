"""Quality rules from line frequencies across documents, in DataFrame functions only.

Normalised lines are hashed together with their host; the documents of each (host, line) are
counted with partial aggregates, so a host or line with a third of all rows is summed before the
shuffle.  Lines above the limit are found by a semi join (a frequent line's rows are split by AQE)
and cut out of the texts, and a document is rejected when too few of its words remain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, saved

_BLANK = " \t\n\x0b\x0c\r"
WINDOW = 8  # words of a repeated passage


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    bare = F.btrim(text, F.lit(_BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _repeated(hashes: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur twice or more."""
    starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def covered(all_: Column) -> Column:
        marked = F.sort_array(F.transform(all_, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def same(s: Column, i: Column, e: Column) -> Column:
            return F.coalesce(F.get(s, i)["h"] == e["h"], F.lit(False))

        twice = let(marked, lambda s: F.transform(
            F.filter(s, lambda e, i: same(s, i - 1, e) | same(s, i + 1, e)), lambda e: e["p"]))
        step = F.aggregate(F.sort_array(twice), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
                           lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["to"], p)).alias("n"),
                                                 (p + WINDOW).alias("to")))
        return step["n"]

    return F.when(F.size(hashes) < WINDOW, F.lit(0)).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))


def text_counts(df: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    base = df.select(*keep, text.alias("_t")).withColumn("_w", words(F.col("_t")))
    kept = [c for c in base.columns if c not in ("_t", "_w")]
    hashes = F.transform(F.col("_w"), lambda w: F.xxhash64(w))
    line = lines(F.col("_t"))
    return base.select(
        *kept, F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(line, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(hashes, _repeated).cast("long").alias("n_repeat_words"))


def _normal(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, SPACE + "+", " ")))


def _key(text: Column, host: Column) -> Column:
    """Identifies a document beside its id: what is removed follows from its text and host."""
    return F.xxhash64(text, host.cast("string"))


def removed_lines(df: DataFrame, id_col: str, text_col: str, host_col: str, max_docs: int) -> DataFrame:
    """(id, key, removed): places, in the \\n-split text, of the lines that more than ``max_docs``
    documents of the same host hold, for documents that have such lines."""
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.col(host_col)
    rows = df.select(F.col(id_col).cast("string").alias("id"), _key(text, host).alias("key"),
                     F.monotonically_increasing_id().alias("row"), host.cast("string").alias("host"),
                     F.split(text, "\n", -1).alias("lines"))  # row: one per document
    rows = rows.select("id", "key", "row", "host", F.posexplode("lines").alias("pos", "line"))
    rows = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    held = saved(rows.select("id", "key", "row", "pos", F.xxhash64("host", _normal(F.col("line"))).alias("h")), "hostlines")
    docs = held.select("h", "row").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("docs"))
    frequent = docs.where(F.col("docs") > max_docs).select("h")
    frequent = saved(frequent, "frequent")  # so that AQE can split the other side of the join
    lost = held.join(frequent, "h", "left_semi").groupBy("id", "key")
    return lost.agg(F.sort_array(F.collect_set("pos")).alias("removed"))  # repeated rows are alike


def line_frequency_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         host_col: str = "source", max_docs: int = 100, min_share: float = 0.5,
                         min_words: int = 20, max_repeat_pct: int = 30) -> DataFrame:
    """(``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    removed_words, kept, ``text_col``, removed), one row per input row.

    Lines are compared lower-cased, trimmed, inner white space as one space; a line that more than
    ``max_docs`` rows of a host hold is removed everywhere in that host, and a document that keeps
    under ``min_share`` of its words is rejected.  ``text_col`` is the text without these lines, of
    rejected documents too, and ``removed`` their places among the \\n-split lines of the original
    text; blank lines stay.  ``base_failed``: fewer than ``min_words`` words, or over
    ``max_repeat_pct`` percent of words in repeated windows, both of the original text.  Null texts
    are empty and fail; null hosts are one host; null ids and repeated rows are judged like others (a
    repeated row counts as a document); an empty table gives none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = text_counts(df, text, [F.col(id_col).alias("id"), _key(text, F.col(host_col)).alias("key"), text.alias("whole")])
    lost = removed_lines(df, id_col, text_col, host_col, max_docs).withColumnsRenamed({"id": "id2", "key": "key2"})
    # written as above, for rows that repeat; merged, as it grows with the input: the texts then move at every size
    lost = saved(lost, "removed").hint("merge")
    both = counts.join(lost, (F.col("key") == F.col("key2")) & F.col("id").cast("string").eqNullSafe(F.col("id2")), "left")
    cleaned = let(F.split("whole", "\n", -1), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("removed")), lambda i: F.get(x, i)), "\n"))
    both = both.withColumn("rest", F.when(F.col("removed").isNull(), F.col("whole")).otherwise(cleaned))
    left = F.when(F.col("removed").isNull(), F.col("n_words")).otherwise(F.size(words(F.col("rest"))).cast("long"))
    both = both.withColumn("left", left)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return both.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (F.col("n_words") - F.col("left")).alias("removed_words"),
                       (~failed & (F.col("left") >= F.lit(min_share) * F.col("n_words"))).alias("kept"),
                       F.col("rest").alias(text_col),
                       F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
