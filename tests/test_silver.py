"""Cleaning, rejection and duplicates on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart.config import Settings
from tidemart.functions.columns import snake_columns, snake_name
from tidemart.operators import silver as ops
from tidemart.schemas import CANONICAL, raw_schema

GOOD = dict.fromkeys(CANONICAL) | {
    "row_id": "1", "order_id": "ORD-1", "order_date": "01-01-2023", "ship_date": "03-01-2023", "customer_id": "CUST-1", "product_id": "PROD-1",
    "category": " office   supplies ", "sub_category": "phones", "sales": "100", "quantity": "2", "discount": "0.1", "profit": "10",
    "shipping_cost": "1", "city": "New  York", "country": "United States", "region": "East", "customer_name": "A", "segment": "Consumer",
}


def frame(spark, *changes):
    return spark.createDataFrame([tuple((GOOD | c)[k] for k in CANONICAL) for c in changes], raw_schema())


def clean(spark, *changes, **kw):
    return ops.flag_places(ops.clean(frame(spark, *changes), Settings(**kw)))


def test_names():
    assert [snake_name(x) for x in ("Row ID", "Sub-Category", "orderDate", " A..B ", "x__y", "Größe")] == ["row_id", "sub_category", "order_date", "a_b", "x_y", "gr_e"]


def test_name_clash(spark):
    with pytest.raises(ValueError, match="share the names"):
        snake_columns(spark.createDataFrame([(1, 2)], "`Order ID` int, order_id int"))


def test_cleaned_values(spark):
    r = clean(spark, {}).first()
    assert (r.category, r.city, r.sales, r.quantity, r.unit_price, r.profit_margin) == ("OFFICE SUPPLIES", "New York", 100.0, 2, 50.0, 0.1)
    assert r.order_date == date(2023, 1, 1) and r.source_row_id == "1" and len(r.row_id) == 64


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"order_id": "  "}, "missing_order_id"),
        ({"product_id": ""}, "missing_product_id"),
        ({"product_id": None}, "missing_product_id"),
        ({"sales": "-100"}, "invalid_sales"),
        ({"sales": "0"}, "invalid_sales"),
        ({"sales": None}, "invalid_sales"),
        ({"sales": "not_a_number"}, "invalid_sales"),
        ({"quantity": "0"}, "invalid_quantity"),
        ({"quantity": "-3"}, "invalid_quantity"),
        ({"quantity": None}, "invalid_quantity"),
        ({"order_date": "invalid-date"}, "missing_date"),
        ({"ship_date": "2023-01-03"}, "missing_date"),
        ({"ship_date": "31-12-2022"}, "date_violation"),
        ({"sales": "0", "quantity": "0"}, "invalid_sales"),
        ({"customer_name": None, "postal_code": None}, None),
    ],
)
def test_reasons(spark, change, reason):
    split = ops.split_faults(clean(spark, change))
    assert [r.rejection_reason for r in split.rejected.collect()] == ([reason] if reason else [])
    assert split.valid.count() == (reason is None)


def test_null_order_id_is_dropped(spark):
    assert clean(spark, {"order_id": None}).count() == 0


def test_cap_comes_before_derived_columns(spark):
    r = clean(spark, {"sales": "15000", "quantity": "3"}).first()
    assert r.sales == 10000 and r.unit_price == 10000 / 3


def test_places(spark):
    flags = [r.geo_quality_flag for r in clean(spark, {"city": "são paulo", "country": "Chile"}, {"city": None}, {}).collect()]
    assert flags == ["INVALID_CITY_COUNTRY", "VALID", "VALID"]


def test_blank_source_row_falls_back_to_the_hash(spark):
    rows = clean(spark, {"row_id": " "}, {"row_id": " ", "product_id": "PROD-2"})
    assert [r.source_row_id for r in rows.collect()] == [None, None]
    assert ops.latest_by_source_row(rows).count() == 2


def test_newest_wins_however_rows_are_dealt(spark):
    rows = clean(spark, {}, {"sales": "200"}, {"row_id": "9", "sales": "300"})
    rows = rows.withColumn("processing_timestamp", F.when(F.col("sales") == 200, F.lit(datetime(2024, 1, 2))).otherwise(F.lit(datetime(2024, 1, 1))))
    for n in (1, 3, 7):
        kept = ops.deduplicate(rows.repartition(n)).collect()
        assert [r.sales for r in kept] == [200.0]


def test_ties_are_broken_the_same_way(spark):
    rows = clean(spark, {}, {"customer_name": "B"}, {"customer_name": "C"})
    assert {ops.deduplicate(rows.repartition(n)).first().customer_name for n in (1, 2, 5)} == {"C"}


def test_residual_duplicates_raise(spark):
    with pytest.raises(ValueError, match="share"):
        ops.assert_unique(clean(spark, {}, {}), "row_id")


def test_legacy_rules(spark):
    r = ops.legacy_clean(frame(spark, {"sales": "-5", "quantity": "0", "discount": "50", "profit": None})).first()
    assert (r.sales, r.quantity, r.discount, r.profit) == (0.0, 1, 0.5, 0.0)


def test_empty(spark):
    assert ops.silver(frame(spark, {}).limit(0)).count() == 0
