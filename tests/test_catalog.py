"""The driver contract: every query has an oracle and plainly named columns."""

import re

import __spark_entry__ as entry

from conftest import SF_SMALL

from ledgermatch.plans import catalog

NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())
    assert len(catalog.QUERIES) >= 57


def test_columns_are_aliased(spark):
    for name, fn in catalog.QUERIES.items():
        cols = fn(spark, SF_SMALL).columns
        bad = [c for c in cols if not NAME.match(c)]
        assert not bad, f"{name} has unaliased columns {bad}"
        assert len(cols) == len(set(cols)), f"{name} repeats a column name"


def test_entry_runs_on_the_smallest_tables(spark):
    df = entry.entry(spark)
    assert df.count() > 1500
    assert "match_status" in df.columns
