"""Quality classifier: a sparse ensemble of rules over text statistics.

A random forest is grown on a bounded sample of labelled documents; every path from a root to a
node is a rule (a conjunction of comparisons).  A lasso logistic regression weighs the rules, most
weights become zero, and the rest is compiled into one Spark column expression that scores all
documents in the JVM.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fold
from .linefreq import let, lines, words

MAX_FIT_ROWS = 20_000  # labelled documents used for the fit, those with the smallest hashed ids

Condition = tuple[str, bool, float]  # (statistic, at most?, bound)


def _holds(rule: tuple[Condition, ...], of: Callable[[str], Column] = F.col) -> Column:
    return reduce(lambda a, b: a & b, [of(f) <= F.lit(b) if most else of(f) > F.lit(b) for f, most, b in rule])


class Model(NamedTuple):
    intercept: float
    rules: list[tuple[float, tuple[Condition, ...]]]

    def score(self, of: Callable[[str], Column] = F.col) -> Column:
        """Probability of label 1 over the columns of :func:`statistics`."""
        # summed in an aggregate over an array: a sum of hundreds of columns would nest too deep
        terms = F.array(F.lit(self.intercept), *[F.when(_holds(r, of), F.lit(w)).otherwise(F.lit(0.0)) for w, r in self.rules])
        total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
        return 1 / (1 + F.exp(-total))


STATISTICS = ("log_words", "word_length", "symbols", "shouts", "pipes", "capitals", "distinct", "digits",
              "stops", "line_words", "same_lines", "odd")


def _statistics(t: Column, w: Column, l: Column) -> list[Column]:
    """The STATISTICS of a text ``t`` with words ``w`` and lines ``l``."""
    n, chars, rows = (F.greatest(x, F.lit(1)) for x in (F.size(w), F.length(t), F.size(l)))

    def matches(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern))

    def of(char: str) -> Column:
        return F.length(t) - F.length(F.replace(t, F.lit(char), F.lit("")))

    found = {
        "log_words": F.log1p(F.size(w).cast("double")), "word_length": F.length(F.array_join(w, "")) / n,
        "symbols": matches(r"[#*$%&<>]") / n, "shouts": of("!") / n, "pipes": of("|") / n,
        "capitals": matches(r"\p{Lu}") / chars, "distinct": F.size(F.array_distinct(w)) / n,
        "digits": matches("[0-9]") / chars, "stops": matches("[.,;:?]") / n, "line_words": F.size(w) / rows,
        "same_lines": (F.size(l) - F.size(F.array_distinct(l))) / rows,
        "odd": matches(r"[^\p{L}\p{N}\s.,;:?!'-]") / chars,
    }
    return [F.coalesce(found[c].cast("double"), F.lit(0.0)).alias(c) for c in STATISTICS]


def statistics(df: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` plus the STATISTICS of ``text`` (doubles, 0 for an empty text)."""
    base = df.select(*keep, text.alias("_t"))
    kept = base.columns[:-1]
    base = base.withColumn("_w", words(F.col("_t"))).withColumn("_l", lines(F.col("_t")))
    return base.select(*kept, *_statistics(F.col("_t"), F.col("_w"), F.col("_l")))


def tidy(path: list[Condition]) -> tuple[Condition, ...]:
    """The conjunction of a path with the tightest bound of each statistic and side, sorted."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, most, bound in path:
        held = bounds.setdefault((name, most), bound)
        bounds[(name, most)] = min(held, bound) if most else max(held, bound)
    return tuple(sorted((name, most, bound) for (name, most), bound in bounds.items()))


def paths(debug: str) -> list[tuple[Condition, ...]]:
    """All distinct rules of a forest, from the text form of its trees."""
    found: dict[tuple[Condition, ...], None] = {}
    path: list[Condition] = []
    for line in debug.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1]) - 4
            path = [*path[:depth], (STATISTICS[int(m[2])], m[3] == "<=", float(m[4]))]
            found[tidy(path)] = None
        elif line.strip().startswith("Tree"):
            path = []
    return list(found)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_FIT_ROWS, seed: int = 11) -> Model:
    """Fit on the labelled rows outside the held-out fold (crc32 of the id modulo 4 is 2), at most
    ``max_rows`` of them.  Without both labels the score is the share of label 1 (one half if there
    are no labels)."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("label"))
                   .where("label in (0, 1) and _id is not null").where(fold("_id", 4) != 2)
                   .orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = statistics(df.select(F.col(id_col).alias("_id"), text.alias("_x")).join(F.broadcast(known), "_id"),
                      F.col("_x"), [F.col("label")])
    rows = checkpointed(rows.repartition(8, *STATISTICS).sortWithinPartitions("label", *STATISTICS))
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        share = (ones + 1) / (n + 2) if n else 0.5
        return Model(math.log(share / (1 - share)), [])
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=24, maxDepth=3, maxBins=64, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", seed=seed).fit(vectors)
    rules = paths(forest.toDebugString)
    if not rules:
        return Model(math.log(ones / (n - ones)), [])
    flags = F.array(*[_holds(rule).cast("double") for rule in rules])
    held = checkpointed(rows.select("label", array_to_vector(flags).alias("features")))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=0.0005, standardization=False, maxIter=40).fit(held)
    weights = lasso.coefficients.toArray()
    return Model(float(lasso.intercept), [(float(w), r) for w, r in zip(weights, rules) if w != 0.0])


def score_documents(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """(``id_col``, held_out, score, predicted), one row per input row.  Null texts score as empty
    ones; null and repeated ids pass through; an empty table gives none.  Only the text is scored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = statistics(df, text, [F.col(id_col).alias("id"), (fold(id_col, 4) == 2).alias("held_out")])
    rows = rows.select("id", "held_out", model.score().alias("score"))
    return rows.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``df``, all columns, that score ``threshold`` or more; no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one expression that evaluates each statistic once; a filter over computed columns would be
    # pushed below them, and every rule would compute its statistics anew
    parts = F.struct(text.alias("t"), words(text).alias("w"), lines(text).alias("l"))
    score = let(parts, lambda p: let(F.struct(*_statistics(p["t"], p["w"], p["l"])),
                                     lambda s: model.score(lambda name: s[name])))
    return df.where(score >= threshold)
