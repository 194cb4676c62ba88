"""Exact quantiles, kept distinct counts and clustering by several columns."""

import random
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemart.operators import quantiles as qu
from tidemart.operators.curve import clustered
from tidemart.operators.distinct import ERROR, estimates, followed, sketches, united
from tidemart.plans.metrics import iqr_outliers, quantile_table

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def columns():
    random.seed(8)
    yield "even", [float(i) for i in range(2000)]
    yield "heavy ties", [random.choice([0.0, -0.0, 1.5, 1.5, 1.5, 7.0]) for _ in range(3000)]
    yield "skewed", [random.lognormvariate(0, 30) * random.choice([1, -1]) for _ in range(3001)]
    yield "odd values", [float("inf"), float("-inf"), float("nan"), 5e-324, -5e-324, 1e308, None, None, 0.1, 0.2]
    yield "one", [3.25]
    yield "equal", [2.5] * 900


@pytest.mark.parametrize("accuracy", [qu.ACCURACY, 20])
def test_quantiles_are_those_of_percentile(spark, monkeypatch, accuracy):
    """Also with a sketch so coarse that many passes are needed."""
    monkeypatch.setattr(qu, "ACCURACY", accuracy)
    for name, values in columns():
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
        want = df.agg(F.percentile("x", F.array(*[F.lit(s) for s in SHARES])).alias("q")).first().q
        assert list(map(str, qu.quantiles(df, "x", SHARES))) == [str(w + 0.0) for w in want], name  # zeros without sign


def test_no_values(spark):
    for df in (spark.createDataFrame([(None,)], "x double"), spark.createDataFrame([], "x double")):
        assert qu.quantiles(df, "x", [0.5, 1.0]) == [None, None]
        assert iqr_outliers(df, "x").count() == 0
        assert [r.value for r in quantile_table(df, "x", 0.5).collect()] == [None]


def test_hardly_anything_is_left_to_later_passes(spark):
    df = spark.range(300_000).select(F.xxhash64("id").cast("double").alias("x"))
    seen = []
    narrow = qu._Rank.narrow

    def spied(self, *args):
        narrow(self, *args)
        seen.append(0 if self.found else self.size)

    qu._Rank.narrow = spied
    try:
        qu.quantiles(df, "x", [0.5])
    finally:
        qu._Rank.narrow = narrow
    assert len(seen) <= 6 and max(seen) < 300_000 * 10 / qu.ACCURACY


def test_sketches_follow_batches(spark):
    rows = [(d, (d * 37 + k) % 5000) for d in range(6) for k in range(2500)] + [(6, None), (None, 3)]
    df = spark.createDataFrame(rows, "day int, customer int")
    kept = None
    for part in (df.where("day < 4 or day is null"), df.where("day between 2 and 6"), df):
        kept = followed(kept, part, ("day",), "customer")
    for window in ([0], [1, 2, 3], [0, 1, 2, 3, 4, 5], [6], [None]):
        exact = len({c for d, c in rows if d in window and c is not None})
        days = kept.where(F.col("day").isin(*[d for d in window if d is not None]) | (F.col("day").isNull() if None in window else F.lit(False)))
        got = estimates(united(days, (), "customer"), "customer").first().customer
        assert abs(got - exact) <= max(1, exact * ERROR)
    once = {r.day: r.customer for r in estimates(sketches(df, ("day",), "customer"), "customer").collect()}
    again = {r.day: r.customer for r in estimates(kept, "customer").collect()}
    assert once.keys() == again.keys() and all(abs(once[d] - again[d]) <= max(1, once[d] * ERROR) for d in once)


def test_files_can_be_skipped_by_either_column(spark, tmp_path):
    first = date(2024, 1, 1)
    data = [(first + timedelta(days=i % 360), (i * 7919) % 1000, "hot" if i % 3 else f"k{i % 50}", i) for i in range(20_000)]
    df = spark.createDataFrame(data, "day date, part int, kind string, n int")
    clustered(df, ["day", "part"], 16).write.option("maxRecordsPerFile", 0).parquet(f"{tmp_path}/c")
    files = [pq.read_table(f, columns=["day", "part"]) for f in sorted(tmp_path.glob("c/*.parquet"))]
    files = [f for f in files if len(f)]
    assert sum(map(len, files)) == 20_000 and max(map(len, files)) < 2.5 * 20_000 / 16
    for column, value in (("day", first + timedelta(days=100)), ("part", 500)):
        ranges = [(min(f[column].to_pylist()), max(f[column].to_pylist())) for f in files]
        assert sum(low <= value <= high for low, high in ranges) <= len(files) / 2
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/c").collect())) == sorted(data)


def test_columns_of_few_values_give_even_files(spark):
    data = [("hot" if i % 3 else "cold", None if i % 5 == 0 else bool(i % 2), i) for i in range(8000)]
    df = spark.createDataFrame(data, "category string, `is current` boolean, n int")
    out = clustered(df, ["category", "is current"], 8)
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 7 and max(sizes) < 2 * 1000
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert clustered(df.limit(0), ["category"], 4).count() == 0
    with pytest.raises(ValueError):
        clustered(df, ["n"] * 8)
