"""Tables that follow batches, against a full rebuild: value by value, after failures, and by what they read."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemart import busy
from tidemart.operators import merge
from tidemart.plans import incremental, marts
from tidemart.plans.incremental import Gold
from tidemart.sources.partitioned import PartitionedTable
from tidemart.sources.scratch import stored


@pytest.fixture(scope="module")
def batches(spark, sf_dir):
    return [stored(b.repartition(2), "batch") for b in busy.loads(spark, sf_dir)]


def rebuilt(gold, silver):
    sales = stored(gold.unified(silver), "sales")
    return marts.daily_unkeyed(marts.natural_fact(sales)), marts.dim_customer(sales, gold.settings, dense=False).drop("customer_key")


def agree(gold, silver):
    daily, customers = rebuilt(gold, silver)
    assert rows_of(gold.daily.read()) == rows_of(daily) and rows_of(gold.customers.read()) == rows_of(customers)


def test_small_batches(spark, batches, tmp_path, monkeypatch):
    """Corrections, another customer and a repeat touch few buckets; a failure halfway is mended by the same batch."""
    gold = Gold(spark, f"file://{tmp_path}/gold", buckets=16)
    first = gold.apply(batches[0], "first")
    assert first.changed == gold.sales.read().count() and len(first.buckets) <= busy.CUSTOMERS
    silver = stored(batches[0], "silver")
    one = silver.orderBy("order_id", "product_id").limit(3)
    later = F.col("processing_timestamp") + F.expr("interval 1 day")
    fixes = stored(one.withColumns({"processing_timestamp": later, "sales": F.col("sales") + 1, "customer_id": F.lit("CUST-3"), "quantity": F.lit(2)}), "fixes")

    real, calls = PartitionedTable.replace, []

    def fails(self, *args):
        calls.append(self.path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(self, *args)

    monkeypatch.setattr(PartitionedTable, "replace", fails)
    with pytest.raises(RuntimeError):
        gold.apply(fixes, "fixes")
    monkeypatch.setattr(PartitionedTable, "replace", real)
    done = gold.apply(fixes, "fixes")
    read = gold.sales.read(*done.buckets).count()
    assert done.changed == 3 and len(done.buckets) <= 4 and 0 < read < gold.sales.read().count() / 2
    silver = stored(merge.merge_rows(silver, fixes), "silver")
    agree(gold, silver)
    files = {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("gold/[dsc]*/bucket=*/*.parquet")}
    assert gold.apply(fixes, "again").changed == 0 and gold.apply(fixes.limit(0), "nothing").changed == 0
    now = {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("gold/[dsc]*/bucket=*/*.parquet")}
    assert {f: t for f, t in now.items() if "/silver/" not in f} == {f: t for f, t in files.items() if "/silver/" not in f}


def test_groups_that_end(spark, batches, tmp_path):
    """All sales of a customer go to another: the customer's groups, row and bucket go."""
    gold = Gold(spark, f"file://{tmp_path}/gold", buckets=64)
    some = stored(batches[1].where("customer_id in ('CUST-1', 'CUST-2')"), "some")
    gold.apply(some, "first")
    later = F.col("processing_timestamp") + F.expr("interval 1 day")
    gold.apply(some.where("customer_id = 'CUST-1'").withColumns({"customer_id": F.lit("CUST-2"), "processing_timestamp": later}), "moved")
    assert {r.customer_id for r in gold.customers.read().collect()} == {"CUST-2"} and len(gold.daily.met(gold.daily.read())) == 1
    agree(gold, gold.silver.read())


def test_the_fixture_reaches_every_branch(spark, sf_dir):
    reasons = {r.rejection_reason for r in busy.REGISTERED["busy_rejections"][0](spark, sf_dir).collect()}
    assert len(reasons) == 6
    daily = busy.REGISTERED["busy_sales_daily"][0](spark, sf_dir)
    most = daily.agg(F.max("transaction_count").alias("n"), F.max("streaming_transactions").alias("s"), F.max("batch_transactions").alias("b")).first()
    assert most.n > 1 and most.s > 0 and most.b > 0


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """A key may hold all rows; few keys are broadcast, and many never."""
    table = PartitionedTable(spark, f"file://{tmp_path}/t", ("k",), 4)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        table.create(spark.range(0, 50_000, 1, 8).select(F.lit("a").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.glob("t/bucket=*"))) == 1 and len(list(tmp_path.glob("t/bucket=*/*.parquet"))) > 1
    table.replace(table.met(table.read()), table.read().where("v < '8'"))
    assert 0 < table.read().count() < 50_000 and table.read().where("v >= '8'").isEmpty()
    assert "broadcast" in incremental.few(table.read().select("k").distinct())._jdf.queryExecution().analyzed().toString()
