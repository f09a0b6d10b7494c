import pytest

from rankloom.plans import oracle
from rankloom.plans import queries as plans


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(name, spark, sf_dir, same_rows):
    same_rows(plans.queries()[name](spark, sf_dir), oracle.SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(oracle.SQL)))
def test_query_without_sql_has_rows(name, spark, sf_dir):
    assert plans.queries()[name](spark, sf_dir).count() > 0


def test_sql_has_queries():
    assert set(oracle.SQL) <= set(plans.queries())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).head(1)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_shuffle_width_does_not_matter(spark, sf_dir):
    run = lambda: sorted(map(tuple, plans.queries()["pairs_all"](spark, sf_dir).collect()))
    wide = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert run() == wide
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
