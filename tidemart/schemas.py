"""Declared schemas: raw batch rows, stream events, the cleaned table."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()  # noqa: E741

# The canonical fields, in order.
CANONICAL = {
    "row_id": I, "order_id": S, "order_date": S, "ship_date": S, "ship_mode": S, "customer_id": S, "customer_name": S,
    "segment": S, "city": S, "state": S, "country": S, "postal_code": S, "market": S, "region": S, "product_id": S,
    "category": S, "sub_category": S, "product_name": S, "sales": D, "quantity": I, "discount": D, "profit": D,
    "shipping_cost": D, "order_priority": S,
}


def canonical_schema() -> T.StructType:
    """24 fields, dates as dd-MM-yyyy text; only the order id is required."""
    return T.StructType([T.StructField(n, t, n != "order_id") for n, t in CANONICAL.items()])


def raw_schema() -> T.StructType:
    """The same fields, all text."""
    return T.StructType([T.StructField(n, S) for n in CANONICAL])


def typed_csv_schema() -> T.StructType:
    """The 21-field variant with typed dates (MM/dd/yyyy), without market, shipping cost and priority."""
    left_out = {"market", "shipping_cost", "order_priority"}
    dates = {"order_date", "ship_date"}
    return T.StructType(
        [T.StructField(n, T.DateType() if n in dates else t) for n, t in CANONICAL.items() if n not in left_out]
    )


def event_schema() -> T.StructType:
    """A stream event: the canonical fields and where and when it was produced."""
    more = [T.StructField(n, S) for n in ("event_timestamp", "source_system", "producer_id")]
    return T.StructType([*[T.StructField(n, t) for n, t in CANONICAL.items()], *more])


NUMBERS = {"sales": "double", "discount": "double", "profit": "double", "shipping_cost": "double", "quantity": "int"}

#: Columns a MERGE sets on a newer match; the others keep what the target has.
MERGE_SET = (
    "row_id", "source_row_id", "order_date", "ship_date", "ship_mode", "customer_id", "segment", "city", "state",
    "country", "postal_code", "market", "region", "product_id", "category", "sub_category", "product_name", "sales",
    "quantity", "discount", "profit", "shipping_cost", "order_priority", "unit_price", "profit_margin",
    "processing_timestamp", "source_system", "batch_id", "partition_date",
)
