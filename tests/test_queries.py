import pytest

import oracle
from sluice.plans import catalogue

pytestmark = pytest.mark.skipif(not oracle.DATA.exists(), reason="the test tables are not here")
SAMPLED = "customer"


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, con, name):
    oracle.compare(spark, con, catalogue.QUERIES[name], catalogue.SQL[name])


def test_a_sample_is_part_of_its_table(spark, con):
    got = catalogue.QUERIES["content_sample"](spark, str(oracle.DATA))
    again = catalogue.QUERIES["content_sample"](spark, str(oracle.DATA))
    table = {tuple(map(str, r)) for r in spark.read.parquet(f"{oracle.DATA}/{SAMPLED}.parquet").select(*got.columns).collect()}
    assert got.count() > 0 and {tuple(map(str, r)) for r in got.collect()} <= table and sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_skew_is_at_least_even(spark):
    r = catalogue.QUERIES["partition_skew"](spark, str(oracle.DATA)).first()
    assert r.ratio >= 1 and r.largest >= r["mean"] > 0


def test_the_consistent_table_has_every_row(spark):
    got = catalogue.QUERIES["p6_table"](spark, str(oracle.DATA))
    want = spark.read.parquet(f"{oracle.DATA}/member_file_row.parquet")
    assert sorted(r[0] for r in got.select("file_row_id").collect()) == sorted(r[0] for r in want.select("file_row_id").collect())


def test_queries_without_sql_are_known():
    assert set(catalogue.QUERIES) - set(catalogue.SQL) == {"content_sample", "partition_skew", "p6_table"}


def test_every_sql_has_a_query():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)


def test_entry_needs_no_text_operators(spark, monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "text_queries", None)
    assert set(e.queries()) == set(catalogue.QUERIES) and e.entry(spark).count() > 0
