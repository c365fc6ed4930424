"""Every registered query against its SQL oracle."""

import os

import pytest

import __spark_entry__ as contract
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORDERED = [
    "running_tumbling", "anchored_tumbling", "batch_wait", "batch_wait_varying", "dedupe_ttl",
    "split_dataflow", "metric_batches", "metric_requests", "snapshot_json", "list_keys_all",
    "doc_insert_ordered",
]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    good, message = oracle.compare(df, sql, con)
    assert good, message
    mine = dict(df.dtypes)
    con.execute(f"create or replace temp view answer as {sql}")
    kinds = {"varchar": "string", "integer": "int"}
    theirs = {r[0]: r[1].lower() for r in con.execute("describe answer").fetchall()}
    assert mine == {c: kinds.get(k, k) for c, k in theirs.items()}


@pytest.mark.parametrize("name", ORDERED)
def test_query_in_many_chunks(spark, con, name):
    """However many chunks the ordered rows fall into, the answers are the same."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        df = contract.queries()[name](spark, FOLDER)
        good, message = oracle.compare(df, contract.oracle_sql()[name], con)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert good, message


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
