"""Every registered key: Spark result equals its DuckDB text (or, without a
text, runs and returns rows)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_harness import compare

# training-data queries have their own tests
QUERIES = {k: v for k, v in E.queries().items() if not k.startswith("op") and k != "pipeline"}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_every_key_has_a_callable_and_most_have_sql():
    assert len(QUERIES) >= 94
    assert set(ORACLE) <= set(QUERIES)
    rows_only = sorted(set(QUERIES) - set(ORACLE))
    # results of a fitted model only
    assert rows_only == ["ml_evaluate", "ml_mlp", "ml_random_forest"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["stream_name", "burst", "letter", "n"]
    rows = df.collect()
    assert rows and all(1 <= r.n <= 5 for r in rows)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, sf_dir, key):
    ok, msg = compare(QUERIES[key](spark, sf_dir), con, ORACLE[key])
    assert ok, msg


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert all("(" not in c and " " not in c for c in df.columns), df.columns  # every column aliased
    assert df.count() > 0


def test_oracle_texts_use_only_registered_views():
    for key, sql in ORACLE.items():
        assert "read_parquet" not in sql and "/root/" not in sql, key


@pytest.mark.parametrize("key", ["survey_avg_year", "crop_box", "stream_window_append"])
def test_trailing_slash_in_scale_folder(spark, sf_dir, key):
    a = QUERIES[key](spark, sf_dir)
    b = QUERIES[key](spark, sf_dir.rstrip("/") + "/")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
