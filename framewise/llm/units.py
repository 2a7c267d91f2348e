"""Substring dedup by hashing clauses: texts are cut into clauses, normalised and digested, digests are
grouped globally, the earliest occurrence stays and the others are removed, with their offsets in
the original text.

A clause ends with punctuation or a line, so a passage inside a longer line, or beside an edited word,
still has the same digests.  Later occurrences that follow each other in a document form one passage,
and a passage goes when it has ``MIN_WORDS`` words or more.  A clause that repeats on its own is
ordinary repetition and stays.

Each digest's earliest place is a partial aggregate, so a clause that a third of all documents hold
is reduced before the shuffle; the clauses then meet it in an equi-join that AQE may split.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, unique_name

MIN_WORDS = 25  # words of a passage that is removed; shorter ones are ordinary repetition
_ROWS = 50_000  # rows of an output batch
_BITS = 24      # of a place that hold the clause's number of words, the bits above its number
_MOST = (1 << _BITS) - 1
_CLAUSE = re.compile(r"[^.!?,;:\n]*[.!?,;:\n]*")
_SPANS = "struct<text:string,removed:array<struct<start:int,end:int>>>"


def units(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, words, 64-bit digest) of every clause with a word, offsets in code points; case and
    white space are ignored.  A clause reaches up to the next one's first character."""
    for match in _CLAUSE.finditer(text):
        words = match.group().lower().split()
        if words:
            yield match.start(), match.end(), len(words), xxhash.xxh3_64_intdigest(" ".join(words).encode()) - (1 << 63)


def repeated_units(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, places): per document the places of its later occurrences in order, each the clause's
    number among the clauses with a word, above its number of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                for n, (_, _, words, digest) in enumerate(units(text)):
                    out.append((digest, doc, key, n << _BITS | min(words, _MOST)))
                    if len(out) >= _ROWS:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["digest", "id", "key", "place"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    found = saved(rows.mapInArrow(run, "digest long, id long, key long, place long"), "units")
    place = F.struct("id", "key", "place")
    first = (found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                  .where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"))
    first = saved(first, "first")  # a plain shuffle on both sides of the join: AQE can split a hot digest
    later = found.join(first, "digest").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "key").agg(F.sort_array(F.collect_set("place")).alias("places"))


def passages(places: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, last) clause numbers of the runs of places that have ``min_words`` words or more."""
    out, first, last, words = [], None, None, 0
    for place in [*places, None]:
        n = None if place is None else place >> _BITS
        if first is not None and n != last + 1:
            if words >= min_words:
                out.append((first, last))
            first = None
        if n is not None:
            first, words = (n, 0) if first is None else (first, words)
            last, words = n, words + (place & _MOST)
    return out


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the runs of clauses, and their (start, end)."""
    kept, spans, at = [], [], 0
    todo = iter(runs)
    run = next(todo)
    for n, (start, end, _, _) in enumerate(units(text)):
        if n == run[0]:
            begin = start
        if n == run[1]:
            kept.append(text[at:begin])
            spans.append((begin, end))
            at, run = end, next(todo, (-1, -1))
    return "".join(kept) + text[at:], spans


def dedup_units(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                removed: str = "removed") -> DataFrame:
    """``df`` with repeated passages of ``min_words`` or more words (clauses that follow each other) removed
    from ``text_col`` and the column ``removed`` (array of start, end of the passages in the original
    text; an input column of that name is replaced).  The earliest occurrence of a clause by (id, text
    hash, clause number) stays, also within one document.  Null texts are empty; null ids rank first;
    repeated rows (same id and text) are one document and come out alike; an empty table gives none."""
    own, key, hits, out = (unique_name(df, n) for n in ("unit_id", "unit_key", "unit_hits", "unit_out"))

    @F.arrow_udf(_SPANS)
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        rows = []
        for text, own_places in zip(texts.to_pylist(), places.to_pylist()):
            runs = passages(own_places, min_words) if own_places else []
            rows.append(without(text, runs) if runs else (text, []))
        spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        return pa.StructArray.from_arrays([pa.array([t for t, _ in rows], pa.string()), spans], ["text", "removed"])

    # written: AQE then splits the rows of a repeated id and text
    found = saved(repeated_units(df, id_col, text_col).select(F.col("id").alias(own), F.col("key").alias(key), F.col("places").alias(hits)), "places")
    text = F.coalesce(df[text_col], F.lit(""))
    both = df.join(found, (F.xxhash64(text) == F.col(key)) & df[id_col].cast("long").eqNullSafe(F.col(own)), "left")
    both = both.withColumn(out, cut(text, F.col(hits)))
    rest = {c: df[c] for c in df.columns if c.lower() != removed.lower()}
    rest[next(c for c in df.columns if c.lower() == text_col.lower())] = F.col(out)["text"]
    return both.select(*[c.alias(n) for n, c in rest.items()], F.col(out)["removed"].alias(removed))
