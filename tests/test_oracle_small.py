"""Registered queries against their DuckDB oracle on sf0.001 (fast subset)."""

import duckdb
import pytest

import __spark_entry__ as E
from decklens.sources.driver_tables import TABLES

SF_SMALL = "/root/testdata/sf0.001"

KEYS = ["deck_features", "expand_decks", "merge_cards", "color_pivot", "baseline_features", "value_counts",
        "describe", "histogram", "metrics_auc", "roc_curve", "classification_report", "split_stratified",
        "knn_neighbours", "clf_knn", "csv_roundtrip", "metrics_summary"]


def _norm(df):
    df = df[sorted(df.columns)]
    rows = []
    for t in df.itertuples(index=False):
        rows.append(tuple("NULL" if v is None or (isinstance(v, float) and v != v)
                          else (round(v, 6) if isinstance(v, float) else str(v)) for v in t))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "competitiveness_score" in df.columns
