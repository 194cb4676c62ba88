"""Every registered query that SQL can express, against DuckDB on the same tables."""

import hashlib

import pytest
from conftest import same_as_sql

from tidemart import queries

GENERATED = "19c5ce18f0a56872de1e23e0bac53e21"  #: digest of the thousand events of the registered query


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(name, spark, duck, sf_dir):
    same_as_sql(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])


def test_what_sql_cannot_say():
    assert queries.QUERIES.keys() - queries.ORACLES.keys() == {"generated_events"}


def test_generated_events_are_these(spark, sf_dir):
    """The events are a function of number, seed and day: the same rows on any session, in whatever partitions."""
    rows = queries.QUERIES["generated_events"](spark, sf_dir).repartition(3).orderBy("row_id", "order_id", "event_timestamp").collect()
    assert len(rows) == 1000
    text = "\n".join("|".join(map(str, r)) for r in sorted(rows, key=str))
    assert hashlib.md5(text.encode()).hexdigest() == GENERATED
    cheap = [r for r in rows if r.discount == 0]
    assert all(abs(r.sales / r.quantity * r.quantity - r.sales) < 0.01 for r in cheap) and 600 < len(cheap) < 800


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()
