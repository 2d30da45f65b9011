"""Every registered query with SQL of its own gives the same rows on another engine."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from sievework.plans import oracles
from sievework.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ORACLES = oracles.oracle_sql()
# Train models, or are approximate by nature; covered by their own tests.
WITHOUT_ORACLE = {
    "numeric_summary",
    "hash_split_xxhash64",
    "model_comparison",
    "two_model_comparison",
    "two_models_from_file",
    "best_model",
    "feature_importance",
    "model_nodes",
    "model_coefficients",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def comparable(rows):
    def value(v):
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(map(value, row)) for row in rows), key=repr)


def test_every_query_has_an_oracle_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck, sf_dir):
    found = entry_points.queries()[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    rows = found.select(expected.columns).collect()
    assert comparable(rows) == comparable(expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
