"""Sales events made from row numbers: the same seed gives the same events, on any number of executors."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.schemas import event_schema

# Pools and ranges that events are drawn from.
PLACES = (
    ("United States", "US", "East", "New York", "NY", "10001"), ("United States", "US", "West", "Los Angeles", "CA", "90001"),
    ("United States", "US", "Central", "Chicago", "IL", "60601"), ("Canada", "Canada", "East", "Toronto", "ON", "M5H 2N2"),
    ("United Kingdom", "EU", "North", "London", None, None), ("Germany", "EU", "Central", "Berlin", None, None),
    ("Japan", "APAC", "North", "Tokyo", None, None), ("Australia", "APAC", "South", "Sydney", None, None),
    ("Brazil", "LATAM", "South", "São Paulo", None, None), ("Nigeria", "Africa", "West", "Lagos", None, None),
)
CATEGORIES = (("Electronics", 50, 2000), ("Clothing", 15, 200), ("Home", 25, 800), ("Books", 5, 60), ("Sports", 10, 300))
QUANTITY_WEIGHTS = (40, 25, 15, 8, 5, 3, 2, 1, 0.5, 0.5)
SEGMENTS = ("Consumer", "Corporate", "Home Office")
SHIP_MODES = ("Same Day", "First Class", "Second Class", "Standard Class")
PRIORITIES = ("Low", "Medium", "High", "Critical")
DISCOUNTED, MOST_DISCOUNT = 0.3, 0.5


def _unit(seed: int, name: str, n: Column) -> Column:
    """A number in [0, 1) drawn from the row number."""
    return F.pmod(F.xxhash64(n, F.lit(name), F.lit(seed)), F.lit(1_000_003)) / 1_000_003


def _pick(pool: tuple, u: Column) -> Column:
    return F.array(*map(F.lit, pool))[F.floor(u * len(pool)).cast("int")]


def _weighted(weights: tuple, u: Column) -> Column:
    """1-based place of the weight that u falls to."""
    total, so_far, out = sum(weights), 0.0, F.lit(len(weights))
    bounds = []
    for w in weights:
        so_far += w
        bounds.append(so_far / total)
    for i in range(len(weights) - 1, 0, -1):
        out = F.when(u < bounds[i - 1], i).otherwise(out)
    return out


def events_from(rows: DataFrame, today: date, seed: int = 1, producer: str = "producer-1", number: str = "id") -> DataFrame:
    """An event for each row number: works on a batch range and on a stream of numbers alike."""
    n = F.col(number)
    u = lambda name: _unit(seed, name, n)
    place = F.array(*[F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(("country", "market", "region", "city", "state", "postal_code"), p, strict=True)]) for p in PLACES])
    kind = F.array(*[F.struct(F.lit(a).alias("name"), F.lit(float(b)).alias("low"), F.lit(float(c)).alias("high")) for a, b, c in CATEGORIES])
    base = rows.select(
        n.alias("_n"),
        place[F.floor(u("place") * len(PLACES)).cast("int")].alias("_p"),
        kind[F.floor(u("kind") * len(CATEGORIES)).cast("int")].alias("_k"),
        _weighted(QUANTITY_WEIGHTS, u("quantity")).cast("int").alias("quantity"),
        F.when(u("discounted") < DISCOUNTED, F.round(u("discount") * MOST_DISCOUNT, 2)).otherwise(0.0).alias("discount"),
        F.round(u("shipping") * 45 + 5, 2).alias("shipping_cost"),
        *[F.col(c) for c in rows.columns if c == "timestamp"],
    )
    n = F.col("_n")
    price = F.round(F.col("_k.low") + u("price") * (F.col("_k.high") - F.col("_k.low")), 2)
    sales = F.round(price * F.col("quantity") * (1 - F.col("discount")), 2)
    ordered = F.date_sub(F.lit(today), F.floor(u("ordered") * 31).cast("int"))
    shipped = F.date_add(ordered, F.floor(u("shipped") * 11).cast("int"))
    digits = lambda name, low, count: (F.floor(u(name) * count) + low).cast("int").cast("string")
    at = F.col("timestamp") if "timestamp" in rows.columns else F.timestamp_seconds(F.unix_seconds(F.lit(today).cast("timestamp")) + n)
    made = {
        "row_id": (F.floor(u("row") * 1_000_000) + 1).cast("int"),
        "order_id": F.concat(F.lit("ORD-"), digits("order", 100_000, 900_000)),
        "order_date": F.date_format(ordered, "dd-MM-yyyy"),
        "ship_date": F.date_format(shipped, "dd-MM-yyyy"),
        "ship_mode": _pick(SHIP_MODES, u("mode")),
        "customer_id": F.concat(F.lit("CUST-"), digits("customer", 10_000, 90_000)),
        "customer_name": F.concat(F.lit("Customer "), digits("customer", 10_000, 90_000)),
        "segment": _pick(SEGMENTS, u("segment")),
        **{k: F.col(f"_p.{k}") for k in ("country", "market", "region", "city", "state", "postal_code")},
        "product_id": F.concat(F.lit("PROD-"), digits("product", 1_000, 9_000)),
        "category": F.col("_k.name"),
        "sub_category": F.concat(F.col("_k.name"), F.lit(" "), digits("sub", 1, 5)),
        "product_name": F.concat(F.lit("Product "), digits("product", 1_000, 9_000)),
        "sales": sales,
        "profit": F.round(sales * (0.1 + 0.3 * u("profit")) - F.col("shipping_cost"), 2),
        "order_priority": _pick(PRIORITIES, u("priority")),
        "event_timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "source_system": F.lit("streaming"),
        "producer_id": F.lit(producer),
    }
    out = base.withColumns(made)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in event_schema()])


def generate(spark: SparkSession, count: int, today: date, seed: int = 1) -> DataFrame:
    return events_from(spark.range(count), today, seed)


def generate_stream(spark: SparkSession, rate: int, today: date, seed: int = 1) -> DataFrame:
    """Events at ``rate`` a second, without end."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    return events_from(rows, today, seed, number="value")


def produce(
    write: Callable[[DataFrame], None], spark: SparkSession, today: date, count: int, batch: int = 1000, rate: float | None = None,
    seed: int = 1, clock=time.monotonic, wait=time.sleep,
) -> int:
    """Hand ``count`` events to ``write`` in batches; the number handed over.

    Without ``rate`` it is a burst, one batch after the other; with it there are never more than ``rate`` events a second
    on average since the start. The events are those of ``generate``, whatever the batches.
    """
    began = clock()
    for low in range(0, count, batch):
        if rate:
            wait(max(0.0, began + low / rate - clock()))
        write(events_from(spark.range(low, min(count, low + batch)), today, seed))
    return max(0, count)


def as_messages(events: DataFrame) -> DataFrame:
    """(key, value) for a message broker: the order id, and the event as JSON."""
    return events.select(F.col("order_id").alias("key"), F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))


def from_messages(messages: DataFrame) -> DataFrame:
    return messages.select(F.from_json(F.col("value").cast("string"), event_schema()).alias("e")).select("e.*")


#: Options of a producer that loses and reorders nothing.
BROKER_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "gzip", "kafka.max.in.flight.requests.per.connection": "1"}


def write_messages(events: DataFrame, servers: str, topic: str = "sales_events") -> None:
    """To a broker; needs Spark's Kafka package on the class path."""
    as_messages(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**BROKER_OPTIONS).save()


def read_messages(spark: SparkSession, servers: str, topic: str = "sales_events") -> DataFrame:
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
