"""Every named query against its SQL oracle on the smallest tables (``ORACLE_SF_DIR`` names others)."""

import os

import pytest

from conftest import SF_DIR
from __spark_entry__ import entry, oracle_sql, queries
from dumpscope.catalog.oracle import ORACLES
from dumpscope.catalog.queries import QUERIES
from tools.compare import connect, rows_of


@pytest.fixture(scope="module")
def sf_dir():
    return os.environ.get("ORACLE_SF_DIR", SF_DIR)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    # The training-data operators are held against brute-force versions in tests/llm; those with SQL are tested there.
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, connection, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    cursor = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows_of(columns, cursor.fetchall())
    assert expected, "the oracle gives no row"
    assert rows_of(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry(spark).count() == 20


@pytest.mark.parametrize(
    "name", ["doc_polarity_joined", "dictionary_text_joined", "lemma_text", "entity_tags_joined", "word_counts", "ranked_title_left"]
)
def test_without_automatic_broadcast(spark, connection, sf_dir, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = queries()[name](spark, sf_dir).collect()
        columns = queries()[name](spark, sf_dir).columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    cursor = connection.execute(oracle_sql()[name])
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(columns, rows) == expected
