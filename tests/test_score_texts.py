"""What the scores of stages write as text, against DuckDB's text of the same numbers."""

import random

import pytest
from pyspark.sql import functions as F

from tidemart.functions.columns import number_text
from tidemart.operators import scores
from tidemart.plans.metrics import iqr_outliers


def test_numbers_are_written_as_duckdb_writes_them(spark, duck):
    random.seed(4)
    values = [36e6, 1e7, 0.0, 1.0, -2.5e-7, 1e16, 9.999e15, 1e-4, 1e-5, 5.5e-7, 5e-324, 123456789012345.67, None]
    values += [random.random() * 10 ** random.randint(-9, 15) for _ in range(500)]
    got = [r.t for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(number_text("v").alias("t")).collect()]
    assert got == [r[0] for r in duck.execute("select cast(v as varchar) from (select unnest(?::double[]) as v)", [values]).fetchall()]


@pytest.mark.parametrize("seconds, rate", [(1e-6, "36000000.0"), (1e8, "3.6e-07")])
def test_rates_of_any_size_are_plain(spark, seconds, rate):
    before = spark.range(36).select(F.lit(1).alias("order_id"))
    after = before.select("order_id", *[F.lit(1.0).alias(c) for c in ("customer_id", "product_id", "unit_price", "quantity", "sales")])
    found = {r.check_name: r.details for r in scores.validate_etl(before, after, seconds).collect()}
    assert found["throughput"] == f'{{"rate":{rate}}}' and found["retention"] == '{"rows_in":36,"rows_out":36}'


@pytest.mark.parametrize("values", [(31869.35, 31869.39), (94118.55, 94118.58), (63896.36, 63897.16), (float("-inf"), float("inf"))])
def test_quartiles_have_the_last_digit_of_the_sql(spark, duck, values):
    sales = spark.createDataFrame([(v,) for v in values], "sales double")
    row = iqr_outliers(sales, "sales").select(number_text("q1").alias("a"), number_text("q3").alias("b")).first()
    if values[1] < float("inf"):
        assert tuple(row) == duck.execute("select cast(quantile_cont(v, 0.25) as varchar), cast(quantile_cont(v, 0.75) as varchar) from (select unnest(?::double[]) as v)", [values]).fetchone()
