"""Models by name, what each is made from, and the order in which to make them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.plans import intermediate as mid, marts, staging
from tidemart.sources.scratch import shares, stored_parts

#: name: (what it reads, how it is made from (spark, settings, *what it reads))
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_sales": (("silver",), lambda spark, s, silver: staging.stg_sales(silver, s)),
    "stg_customers": (("stg_sales",), lambda spark, s, sales: staging.stg_customers(sales, s)),
    "stg_products": (("stg_sales",), lambda spark, s, sales: staging.stg_products(sales, s)),
    "int_sales_unified": (("stg_sales",), lambda spark, s, sales: mid.unified_sales(sales, s)),
    "int_product_scd2": (("stg_products",), lambda spark, s, products: mid.product_versions(products, s)),
    "int_store_scd2": (("stg_customers",), lambda spark, s, customers: mid.store_versions(customers, s)),
    "int_date_spine": ((), lambda spark, s: mid.date_spine(spark, s)),
    "dim_date": (("int_date_spine",), lambda spark, s, spine: marts.dim_date(spark, spine, s)),
    "dim_product": (("int_product_scd2",), lambda spark, s, versions: marts.dim_product(versions, s)),
    "dim_store": (("int_store_scd2",), lambda spark, s, versions: marts.dim_store(versions, s)),
    "dim_customer": (("int_sales_unified",), lambda spark, s, unified: marts.dim_customer(unified, s)),
    "fact_sales": (
        ("int_sales_unified", "dim_date", "dim_product", "dim_store", "dim_customer"),
        lambda spark, s, *tables: marts.fact_sales(*tables),
    ),
    "fact_sales_daily": (("fact_sales",), lambda spark, s, fact: marts.fact_sales_daily(fact)),
}

#: Of models that are made by grouping sales, the key by which they may be made a share at a time.
GROUPED = {
    "int_product_scd2": "product_id", "int_store_scd2": "store_id", "dim_product": "product_id", "dim_store": "store_id", "dim_customer": "customer_id",
}

#: Columns that the tables are clustered by when they are stored, so that readers can skip files by any of them.
CLUSTERED = {
    "dim_customer": ("customer_segment", "is_active"),
    "dim_product": ("category", "is_current"),
    "dim_store": ("region", "is_current"),
    "fact_sales": ("date_key", "store_key"),
    "fact_sales_daily": ("date_key", "store_key"),
}


def build_order(models=MODELS) -> list[str]:
    """Every model after what it reads; a circle is an error."""
    return [n for n in TopologicalSorter({k: v[0] for k, v in models.items()}).static_order() if n in models]


class Warehouse:
    """The models over one cleaned table, each planned once.

    ``keep``: models to hold in memory; ``store``: models to write to the shared folder when they are first read, for
    those that several others are made from; ``models``: other ways to make some; ``parts``: in how many shares to make and
    write models that group sales. Nothing is made that nobody reads.
    """

    def __init__(
        self,
        spark: SparkSession,
        silver: DataFrame,
        settings: Settings = DEFAULT,
        keep: tuple[str, ...] = (),
        store: tuple[str, ...] = (),
        models: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] | None = None,
        parts: int = 1,
    ):
        self.spark, self.settings, self.keep, self.store = spark, settings, keep, store
        self.models = MODELS | (models or {})
        self.made: dict[str, DataFrame] = {"silver": silver}
        self.parts = parts

    def together(self, *names: str, small: bool = True) -> None:
        """Write models that do not read each other at the same time, so that small jobs share the executors; if they are
        not ``small``, one after the other, so that what one shuffled is gone when the next begins."""
        plans = {n: self._plan(n) for n in names if n not in self.made}
        if not small:
            for name, df in plans.items():
                self.made[name] = self.written(name, df)
        elif plans:
            with ThreadPoolExecutor(len(plans)) as pool:
                self.made |= zip(plans, pool.map(lambda item: self.written(*item), plans.items()), strict=True)

    def _plan(self, name: str) -> DataFrame:
        reads, make = self.models[name]
        return make(self.spark, self.settings, *[self[r] for r in reads])

    def written(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """A model, or some columns of it with its key, written share by share."""
        df = self[name] if df is None else df
        parts = shares(F.col(GROUPED[name]), self.parts) if name in GROUPED else [F.lit(True)]
        return stored_parts((df.where(x) for x in parts), name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            df = self._plan(name)
            if name in self.store:
                df = self.written(name, df)
            self.made[name] = df.persist() if name in self.keep else df
        return self.made[name]

    def release(self) -> None:
        for name in self.keep:
            if name in self.made:
                self.made[name].unpersist()
