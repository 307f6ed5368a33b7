"""Every query with SQL gives the same rows in DuckDB; the fitted models run in test_models."""

import duckdb
import pytest

import __spark_entry__ as spark_entry

TABLES = "documents embeddings labels conversations benchmark".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def normal(pdf):
    pdf = pdf[sorted(pdf.columns)]
    cell = lambda v: None if v != v or v is None else (float(v) if isinstance(v, (int, float)) or hasattr(v, "dtype") else v)
    rows = [tuple(cell(v) for v in row) for row in pdf.itertuples(index=False)]
    return list(pdf.columns), sorted(rows, key=repr)


# Tens of thousands of fits, and thirty mixtures: minutes each. tools/check.py compares them with their SQL, test_trainers their parts.
MANY_FITS = {"learning_curve_grid", "gmm_sweep"}


@pytest.mark.parametrize("name", sorted(set(spark_entry.oracle_sql()) - MANY_FITS))
def test_query_matches_sql(spark, sf_dir, db, name):
    got = normal(spark_entry.queries()[name](spark, sf_dir).toPandas())
    want = normal(db.execute(spark_entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["term", "n", "frequency"] and df.count() == 200


def test_every_query_is_named_once():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
