"""Line deduplication by probing a sharded minimal perfect hash.

1. Each document's normalised line hashes are written once to the shared folder, in chunks.
2. Every chunk asks every shard about its distinct hashes and says how many of its documents hold
   each (one binary row per chunk and shard).  Shards split the hash space evenly, so a line that a
   third of all documents share is one entry per chunk, not a group of rows.
3. A shard adds the counts up, builds a minimal perfect hash (levels of bit arrays with a rank
   directory) over its distinct hashes, and stores fingerprint and count arrays at its indices.  The
   chunks' hashes probe these arrays; no line is joined with another line.
4. The frequent hashes go back to their chunk, which marks the lines of its documents; texts meet
   the marks by document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, unique_name
from .words import mix

SHARD_LINES = 1 << 17  # lines a shard is sized for
_STRIP = b" \t\n\x0b\x0c\r"


class CountTable:
    """Counts of distinct 64-bit keys behind a minimal perfect hash.

    Level i keeps one bit per slot that exactly one remaining key maps to; a key's index is the
    rank of its bit.  ``prints`` tells strangers from members (32 bits)."""

    GAMMA, LEVELS = 2, 48

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        rest, first = keys, 0
        while len(rest) and len(self.levels) < self.LEVELS:
            slots = 64 * (len(rest) * self.GAMMA // 64 + 1)
            at = self._slot(rest, len(self.levels), slots)
            once = np.bincount(at, minlength=slots) == 1
            words = np.packbits(once, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((words, first + np.cumsum(ones) - ones, slots))
            first += int(ones.sum())
            rest = rest[~once[at]]
        self.late = np.sort(rest)  # keys that no level could place (none in practice)
        self.prints = np.zeros(len(keys), np.uint32)
        self.counts = np.zeros(len(keys), np.uint32)
        index, _ = self._index(keys)
        self.prints[index] = self._print(keys)
        self.counts[index] = np.minimum(counts, 0xFFFFFFFF)

    @staticmethod
    def _slot(keys: np.ndarray, level: int, slots: int) -> np.ndarray:
        salt = mix(np.array([level + 1], np.uint64))
        return (mix(keys ^ salt) % np.uint64(slots)).astype(np.int64)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix(~keys) >> np.uint64(32)).astype(np.uint32)

    def _index(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, found a slot)"""
        index, open_ = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for n, (words, before, slots) in enumerate(self.levels):
            at = self._slot(keys[open_], n, slots)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            index[open_[hit]] = (before[at >> 6] + below)[hit]
            open_ = open_[~hit]
        found = np.ones(len(keys), bool)
        if len(open_):
            at = np.searchsorted(self.late, keys[open_])
            ok = np.append(self.late, np.uint64(0))[at] == keys[open_]
            ok &= at < len(self.late)
            index[open_] = np.where(ok, len(self.prints) - len(self.late) + at, 0)
            found[open_] = ok
        return index, found

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Counts of ``keys``; a key that is not a member counts 0 (up to 32 bits of fingerprint)."""
        if not len(self.prints):
            return np.zeros(len(keys), np.int64)
        index, found = self._index(keys)
        found &= self.prints[index] == self._print(keys)
        return np.where(found, self.counts[index], 0).astype(np.int64)


def line_hashes(text: bytes | None, min_chars: int) -> list[int]:
    """One hash per line of a text; 0 for a line whose key is shorter than ``min_chars``."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(_STRIP).lower()
        short = len(key) < min_chars or min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars
        out.append(0 if short else xxhash.xxh3_64_intdigest(key) or 1)
    return out


def _line_table(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(chunk, id, text_key, n_lines, hashes): one row per document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for n, batch in enumerate(batches):
            rows = [np.array(line_hashes(t, min_chars), np.uint64) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), part + n, np.int64)), batch.column(0), batch.column(1),
                 pa.array([len(r) for r in rows], pa.int64()),
                 pa.array([r.tobytes() for r in rows], pa.binary())],
                ["chunk", "id", "text_key", "n_lines", "hashes"])

    rows = df.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                     F.col(text_col).cast("binary").alias("text"))
    return saved(rows.mapInArrow(run, "chunk long, id string, text_key long, n_lines long, hashes binary"), "lines")


def _requests(lines: DataFrame, shards: int) -> DataFrame:
    """(shard, chunk, hashes, docs): per chunk and shard, its distinct hashes and document counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            blobs = batch.column(1).to_pylist()
            out: list[tuple] = []
            for chunk in np.unique(chunks):
                own = [np.unique(np.frombuffer(blobs[i], np.uint64)) for i in np.flatnonzero(chunks == chunk)]
                keys, docs = np.unique(np.concatenate(own), return_counts=True)
                docs = docs[keys != 0].astype(np.uint32)
                keys = keys[keys != 0]
                shard = ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                out += [(s, int(chunk), keys[order[a:b]].tobytes(), docs[order[a:b]].tobytes())
                        for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["shard", "chunk", "hashes", "docs"])

    return lines.select("chunk", "hashes").mapInArrow(run, "shard int, chunk long, hashes binary, docs binary")


def _answers(requests: DataFrame, min_docs: int) -> DataFrame:
    """(chunk, frequent): for each chunk, those of its hashes that ``min_docs`` documents hold."""

    def run(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(b, np.uint64) for b in table["hashes"].to_pylist()]
        docs = np.concatenate([np.frombuffer(b, np.uint32) for b in table["docs"].to_pylist()])
        keys, where = np.unique(np.concatenate(asked), return_inverse=True)
        counts = CountTable(keys, np.bincount(where, weights=docs).astype(np.int64))
        found = [(chunk, hot.tobytes()) for chunk, a in zip(table["chunk"].to_pylist(), asked)
                 if len(hot := a[counts.count(a) >= min_docs])]
        return pa.table({"chunk": pa.array([f[0] for f in found], pa.int64()),
                         "frequent": pa.array([f[1] for f in found], pa.binary())})

    return requests.groupBy("shard").applyInArrow(run, "chunk long, frequent binary")


def _marks(lines: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, text_key, drop): documents with a frequent line, one flag per line."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, keys, drop = [], [], []
        if right.num_rows:
            hot = np.concatenate([np.frombuffer(b, np.uint64) for b in right["frequent"].to_pylist()])
            for doc, key, blob in zip(*(left[c].to_pylist() for c in ("id", "text_key", "hashes"))):
                mark = np.isin(np.frombuffer(blob, np.uint64), hot)
                if mark.any():
                    ids.append(doc)
                    keys.append(key)
                    drop.append(mark)
        return pa.table({"id": pa.array(ids, pa.string()), "text_key": pa.array(keys, pa.int64()),
                         "drop": pa.array(drop, pa.list_(pa.bool_()))})

    return (lines.groupBy("chunk").cogroup(answers.groupBy("chunk"))
                 .applyInArrow(run, "id string, text_key long, drop array<boolean>")
                 .dropDuplicates(["id", "text_key"]))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                min_chars: int = 1, shard_lines: int = SHARD_LINES, n_lines: str = "n_lines",
                n_dropped: str = "n_dropped") -> DataFrame:
    """``df`` with frequent lines removed from ``text_col``, plus the line counts ``n_lines``
    (before) and ``n_dropped``; input columns of those two names are replaced.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  Keys of at
    least ``min_chars`` code points that ``min_docs`` or more rows hold lose all their lines in
    every row.  A null or empty text is one empty line and comes back empty; a repeated row counts
    as a document of its own; null ids are allowed; an empty table gives an empty table; other
    columns pass through."""
    lines = _line_table(df, id_col, text_col, min_chars)
    total = lines.agg(F.sum("n_lines")).first()[0] or 0
    shards = max(1, -(-total // shard_lines))
    marks = _marks(lines.select("chunk", "id", "text_key", "hashes"), _answers(_requests(lines, shards), min_docs))
    key, drop, own_id = (unique_name(df, n) for n in ("text_key", "drop", "mark_id"))
    marks = marks.select(F.col("id").alias(own_id), F.col("text_key").alias(key), F.col("drop").alias(drop))
    on = (F.xxhash64(df[text_col]) == F.col(key)) & df[id_col].cast("string").eqNullSafe(F.col(own_id))
    both = df.join(marks, on, "left")
    text = F.coalesce(df[text_col], F.lit(""))
    flag = F.col(drop)
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.get(flag, i)), "\n")
    rest = {c: df[c] for c in df.columns if c.lower() not in {n_lines.lower(), n_dropped.lower()}}
    rest[next(c for c in df.columns if c.lower() == text_col.lower())] = F.when(flag.isNull(), text).otherwise(kept)
    return both.select(*[c.alias(n) for n, c in rest.items()],
                       (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias(n_lines),
                       F.coalesce(F.size(F.filter(flag, lambda x: x)), F.lit(0)).cast("long").alias(n_dropped))
