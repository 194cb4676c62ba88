"""Raw rows to the cleaned table: clean, flag places, split off faults, remove duplicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemart.config import DEFAULT, Settings
from tidemart.functions import columns as c
from tidemart.schemas import NUMBERS

# City and country that cannot go together, upper case.
IMPOSSIBLE_PLACES = (("SÃO PAULO", "CHILE"), ("BUENOS AIRES", "CHILE"), ("LAGOS", "SOUTH AFRICA"))
UPPER = ("category", "sub_category")
KEPT_CASE = ("segment", "region", "country", "state", "city")
IDS = ("order_id", "product_id", "customer_id")


def with_source_row_id(df: DataFrame) -> DataFrame:
    """``row_id`` under its lasting name, as text; a null column where there is none. Blank is null."""
    if "row_id" in df.columns and "source_row_id" not in df.columns:
        df = df.withColumnRenamed("row_id", "source_row_id")
    if "source_row_id" not in df.columns:
        df = df.withColumn("source_row_id", F.lit(None).cast("string"))
    return df.withColumn("source_row_id", c.blank_to_null(F.col("source_row_id").cast("string")))


def clean(
    df: DataFrame, settings: Settings = DEFAULT, date_formats: tuple[str, ...] = ("dd-MM-yyyy",), source_system: Column | None = None
) -> DataFrame:
    """Typed, trimmed and derived columns; rows without an order id go.

    ``source_system``: that of each row, where not all come from the one of the settings. Bad dates and numbers become null. Sales above the threshold are capped before unit price and margin are derived.
    Two projections in all. A ``processing_timestamp`` that is there already is kept.
    """
    df = with_source_row_id(df.where(F.col("order_id").isNotNull()))
    has = set(df.columns)
    new: dict[str, Column] = {x: c.trimmed(x) for x in IDS if x in has}
    new |= {x: F.upper(c.squeezed(x)) for x in UPPER if x in has}
    new |= {x: c.squeezed(x) for x in KEPT_CASE if x in has}
    for x in ("order_date", "ship_date"):
        if isinstance(df.schema[x].dataType, T.StringType):
            new[x] = c.to_date_or_null(x, date_formats)
    new |= {x: c.cast_or_null(x, kind) for x, kind in NUMBERS.items() if x in has}
    new["sales"] = c.capped(new["sales"], settings.sales_threshold)
    now = F.lit(settings.as_of).cast("timestamp")
    if "processing_timestamp" not in has:
        new["processing_timestamp"] = now
    new |= {
        "ingestion_timestamp": now,
        "source_system": F.lit(settings.source_system) if source_system is None else source_system,
        "batch_id": F.lit(settings.batch_id),
        "partition_date": F.date_format(F.lit(settings.as_of), "yyyy-MM-dd"),
    }
    df = df.withColumns(new)
    return df.withColumns(
        {
            "unit_price": F.when(F.col("quantity") > 0, F.col("sales") / F.col("quantity")).otherwise(0.0),
            "profit_margin": F.when(F.col("sales") > 0, F.col("profit") / F.col("sales")).otherwise(0.0),
            "row_id": c.row_hash("source_row_id", "order_id", "product_id", "source_system"),
        }
    )


def legacy_clean(df: DataFrame) -> DataFrame:
    """The older rules: repair numbers instead of rejecting them, then keep valid rows."""
    s, q, d = (c.cast_or_null(x, NUMBERS[x]) for x in ("sales", "quantity", "discount"))
    fixed = df.withColumns(
        {
            "sales": F.when(s.isNull() | (s < 0), 0.0).otherwise(s),
            "quantity": F.when(q.isNull() | (q <= 0), 1).otherwise(q),
            "discount": F.when(d.isNull() | (d < 0), 0.0).when(d > 1, d / 100).otherwise(d),
            "profit": F.coalesce(c.cast_or_null("profit", "double"), F.lit(0.0)),
        }
    )
    return fixed.where(
        F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & F.col("product_id").isNotNull() & F.col("order_date").isNotNull()
    )


def flag_places(df: DataFrame, impossible=IMPOSSIBLE_PLACES) -> DataFrame:
    """``geo_quality_flag``: INVALID_CITY_COUNTRY for an impossible pair, else VALID."""
    city, country = F.upper(c.trimmed("city")), F.upper(c.trimmed("country"))
    wrong = F.lit(False)
    for a, b in impossible:
        wrong = wrong | ((city == a) & (country == b))
    return df.withColumn("geo_quality_flag", F.when(wrong, "INVALID_CITY_COUNTRY").otherwise("VALID"))


def rejection_reason() -> Column:
    """The first rule a cleaned row breaks, else null."""
    return c.first_fault(
        [
            ("missing_order_id", F.col("order_id").isNull() | (F.col("order_id") == "")),
            ("missing_product_id", F.col("product_id").isNull() | (F.col("product_id") == "")),
            ("invalid_sales", F.col("sales").isNull() | (F.col("sales") <= 0)),
            ("invalid_quantity", F.col("quantity").isNull() | (F.col("quantity") <= 0)),
            ("missing_date", F.col("order_date").isNull() | F.col("ship_date").isNull()),
            ("date_violation", F.col("order_date") > F.col("ship_date")),
        ]
    )


@dataclass
class Split:
    valid: DataFrame
    rejected: DataFrame  #: with ``rejection_reason``


def split_faults(df: DataFrame) -> Split:
    """Valid and rejected rows. Both read the same frame: persist it first if both are written."""
    judged = df.withColumn("rejection_reason", rejection_reason())
    reason = F.col("rejection_reason")
    return Split(judged.where(reason.isNull()).drop("rejection_reason"), judged.where(reason.isNotNull()))


def rejection_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("row_count"))


def _latest(df: DataFrame, keys: list[Column], ties: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """One row a key: the newest, ties broken by all the columns named, so that no partitioning changes the choice.

    The row is chosen as a maximum of structs, which is pre-aggregated on the map side: a key may hold any share of rows.
    ``within``: columns on which the rows of a key agree. Where rows lie by these, as after a join on them, they are not
    dealt again.
    """
    rest = [x for x in df.columns if x not in ties and x not in within]
    order = F.struct(F.coalesce("processing_timestamp", F.lit(0).cast("timestamp")).alias("_at"), *ties, *rest)
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    best = df.withColumns(named).groupBy(*within, *named).agg(F.max(order).alias("_row"))
    return best.select(*[F.col(x) if x in within else F.col(f"_row.{x}").alias(x) for x in df.columns])


TIES = ["order_id", "product_id", "source_row_id", "ship_date", "sales", "quantity"]


def latest_by_source_row(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """The newest row of each source row id (of each hashed row id where that is missing)."""
    return _latest(df, [F.coalesce("source_row_id", "row_id")], TIES, within)


def latest_by_order_product(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    return _latest(df, [F.col("order_id"), F.col("product_id")], TIES, within)


def deduplicate(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """First one row a source row, then one a business key.

    ``within``: columns on which rows of one source row agree, and rows of one key (see ``_latest``); they go.
    """
    return latest_by_order_product(latest_by_source_row(df, within), within).drop(*within)


def residual_duplicates(df: DataFrame) -> DataFrame:
    return df.groupBy("row_id").agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, or an error if rows share the keys."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"rows share {keys}: {[tuple(r) for r in twice]}")
    return df


def silver(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Raw canonical rows to the cleaned table."""
    return deduplicate(split_faults(flag_places(clean(df, settings))).valid)


def first_in_window(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given, by a ranked window (pruned before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
