import pytest
from conftest import SMALL
from parity import rows_of

from routeloom.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL.replace("0.001", "0.01")).count() > 0


@pytest.mark.parametrize("name", ["trajectory_length", "rect_components", "model_select", "review_queue"])
def test_same_with_other_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(rows_of(QUERIES[name](spark, SMALL).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
