import re

import pytest

import __spark_entry__ as entry_module
from compare import difference

SF = "/root/testdata/sf0.001"
OWN = re.compile(r"(?!op\d+_|pipeline$)")  # the training-data operators have tests of their own
QUERIES = {n: q for n, q in entry_module.queries().items() if OWN.match(n)}
ORACLE = {n: q for n, q in entry_module.oracle_sql().items() if OWN.match(n)}


def test_every_query_has_expected_results():
    assert set(QUERIES) == set(ORACLE)


def test_reports_are_all_line_items(spark):
    assert QUERIES["source_reports"](spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


@pytest.mark.parametrize("name", ["fk_orphans_daily", "fk_orphans_monthly", "fk_orphans_reportage", "lookup_rivals"])
def test_broken_rows_are_in_the_fixture(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    found, _, _ = difference(spark, SF, QUERIES[name], ORACLE[name])
    assert found is None, found


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
