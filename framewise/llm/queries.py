"""Registered queries of this subpackage and the DuckDB text of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, linefreq, minhash, ngram, pii, rules, sharding, simhash, spelling, turns
from .common import read_table
from .lines import dedup_lines
from .units import dedup_units

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary_path() -> str:
    """The vocabulary file of the production runs; the operator takes any path."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql.strip()
        return fn
    return add


@query("op1_simhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query("op2_lm_score")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score_documents(read_table(spark, sf_dir, "documents"))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_units(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return kept.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join(spans, ",").alias("removed"),
                       F.sha2("text", 256).alias("kept_sha256"))


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=16)


_OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower_az(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower_az(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + least(13, len(w)) - 1] AS t
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(t) AS n FROM win),
hits AS (SELECT p.doc_id, p.i, p.n, win.item_id
         FROM (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n) p
         JOIN win ON win.t = p.w[p.i:p.i + p.n - 1]),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS q FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit,
       coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
_LOWER_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op5_decontamination", _OP5_SQL.replace("lower_az(text)", _LOWER_AZ))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                   window=13, share=20)
    return found.select(F.col("id").cast("long").alias("doc_id"), "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, source, x, lower(regexp_replace(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             '[\x20\x09-\x0D]+', ' ', 'g')) AS k, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
hot AS (SELECT source, k FROM l GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 100),
lost AS (SELECT doc_id, sum(n) AS gone FROM l JOIN hot ON l.source IS NOT DISTINCT FROM hot.source AND l.k = hot.k GROUP BY 1),
dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM l GROUP BY 1),
win AS (SELECT doc_id, i, w[i:i + 7] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY 1),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
                CAST(coalesce(lost.gone, 0) AS BIGINT) AS removed_words
         FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - removed_words >= 0.5 * n_words AS kept
FROM base
"""


@query("op6_line_frequency", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.line_frequency_rules(read_table(spark, sf_dir, "documents")).drop("text", "removed")


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.encode_documents(docs, vocabulary_path())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


_OP8_SQL = r"""
WITH l AS (SELECT doc_id, i, s[i] AS x,
                  translate(trim(s[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS i
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
hot AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (FROM hot)) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (k NOT IN (FROM hot)), '')) AS kept_sha256
FROM l GROUP BY doc_id
"""


@query("op8_line_dedup", _OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return rules.score_documents(docs, rules.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [of(kind) for kind in ("email", "ip", "card", "phone")]
    scores = F.array_join(F.transform("spans", lambda s: F.round(s["score"], 2).cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
                        scores.alias("scores"))


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


_OP12_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower_az(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN generate_series(1, len(w) - 2)]
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
meet AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q USING (x) WHERE p.doc_id <> q.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM meet JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(node, root) AS (SELECT doc_id, doc_id FROM documents
                      UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.node WHERE reach.root < link.b)
SELECT reach.node AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id, min(root) = reach.node AS kept
FROM reach LEFT JOIN n ON n.doc_id = reach.node GROUP BY reach.node
"""


@query("op12_minhash_dedup", _OP12_SQL.replace("lower_az(text)", _LOWER_AZ))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.repair_report(conversations, turns.damage(conversations))
