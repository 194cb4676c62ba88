"""What queries leave on disk: no second copy of rows in shuffles, no scratch of finished steps."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows_of, same_as_sql

from tidemart import busy, queries
from tidemart.operators import ranges, silver as ops
from tidemart.operators.keys import ranged_keys
from tidemart.operators.merge import merge_rows
from tidemart.plans import marts, registry, staging, suites
from tidemart.plans.registry import Warehouse
from tidemart.sources import adapter, partitioned, scratch


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [queries.silver, busy.sales])
def test_lines_are_deduplicated_where_the_join_leaves_them(spark, sf_dir, unbroadcast, query):
    found = plan(query(spark, sf_dir))
    assert not re.findall(r"Exchange hashpartitioning\(.*_k\d", found)
    assert len(re.findall(r"FileScan parquet.*l_linenumber", found)) == 1


def test_rows_of_a_key_in_one_order(spark):
    """With the order named, the same rows stay as without."""
    rows = [(n, f"{n % 5}-{n % 3}", f"h{n}", f"O{n % 5}", f"P{n % 2}", n % 4, float(n % 6), n % 5) for n in range(60)]
    df = spark.createDataFrame(rows, "_id long, source_row_id string, row_id string, order_id string, product_id string, quantity int, sales double, o long")
    df = df.withColumns({"processing_timestamp": F.timestamp_seconds(F.col("_id") % 7), "ship_date": F.lit(None).cast("date")})
    assert sorted(ops.deduplicate(df, ("o",)).collect()) == sorted(ops.deduplicate(df.drop("o")).select(*[c for c in df.columns if c != "o"]).collect())


def test_a_merge_leaves_its_table_alone(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    queries.merged(spark, sf_dir)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["silver"]


def test_tables_that_follow_leave_no_scratch(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    monkeypatch.setattr(busy, "_made", {})
    busy.followed(spark, sf_dir)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["gold"]


def test_stored_sales_of_odd_tables_are_those_of_silver(spark, sf_dir, tmp_path):
    """Rows of one source row that name several parts, some not there; repeated parts, customers and orders; lost customers."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    lines, key = t("lineitem").where("l_orderkey % 10 = 1"), F.col("l_orderkey")
    later = lines.withColumns({"l_partkey": F.when(key % 3 == 0, -1).otherwise(F.col("l_partkey") + 1), "l_shipdate": F.expr("l_shipdate + interval 400 days")})
    orders, people, part = t("orders"), t("customer").where("c_custkey % 7 <> 0"), t("part")
    odd = {
        "lineitem": lines.unionByName(later.select(*[F.col(c).cast(kind) for c, kind in lines.dtypes])),
        "orders": orders.unionByName(orders.where("o_orderkey % 4 = 1").withColumn("o_custkey", F.lit(-1).cast(orders.schema["o_custkey"].dataType))),
        "customer": people.unionByName(people.where("c_custkey % 2 = 0").withColumn("c_name", F.lit("zz"))),
        "part": part.unionByName(part.where("p_partkey % 2 = 0").withColumns({"p_type": F.lower("p_type"), "p_name": F.lit("a")})),
        "nation": t("nation"),
        "region": t("region"),
    }
    for name, df in odd.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    want = rows_of(queries.silver(spark, str(tmp_path)).select(*staging.READ))
    assert len(want) > 100 and rows_of(queries.kept(spark, str(tmp_path))) == want


def joins(df) -> int:
    return len(re.findall(r"SortMergeJoin|ShuffledHashJoin", plan(df).split("== Initial Plan ==")[-1]))


def test_reports_join_and_deal_what_they_read(spark, sf_dir, unbroadcast):
    """The date, the product and the place decide what counts; no key is dealt to be told apart, no dimension met unread."""
    found = queries.QUERIES["kpis"](spark, sf_dir)
    assert joins(found) <= 3 and "sales_key" not in plan(found)
    assert joins(queries.QUERIES["top_products"](spark, sf_dir)) <= 4


def test_checks_of_versions_read_them_stored(spark, sf_dir):
    assert "l_extendedprice" not in plan(queries.QUERIES["check_scd2"](spark, sf_dir))


def test_joins_of_the_fact_do_not_carry_what_follows(spark, sf_dir, unbroadcast):
    w = Warehouse(spark, queries.silver(spark, sf_dir))
    found = plan(marts.fact_for_reports(*[w[t] for t in queries.DIMENSIONS[:1]], w["dim_date"], *[w["int_product_scd2"].withColumn("product_key", F.col("product_id"))], w["int_store_scd2"].withColumn("store_key", F.col("store_id"))))
    above, below = found.split("SortMergeJoin", 1)
    assert "MORNING" in above and "MORNING" not in below


SLICED = ("business_rules", "check_scd2", "recent_facts", "incomplete_days", "dimensional_integrity", "kpis_by_segment")


@pytest.mark.parametrize("name", SLICED)
def test_large_tables_are_worked_on_in_slices(spark, sf_dir, duck, monkeypatch, name):
    """As if lines filled three slices: the same rows, and lines are never shuffled at once."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    written, write = {}, scratch.stored_parts
    count = lambda parts, label, root=None: write([written.setdefault(label, []).append(0) or p for p in parts], label, root)
    for module in (queries, ranges, suites):
        monkeypatch.setattr(module, "stored_parts", count)
    same_as_sql(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])
    none = ("incomplete_days", "check_scd2", "recent_facts")  # of some days only, of no sales, or in order of its number
    assert len(written["lines"]) == 3 and ("fact" in written) == (name not in none)
    assert all(len(parts) % 3 == 0 for label, parts in written.items() if label in ("fact", "counts"))
    if name == "recent_facts":
        assert len(written["ranges"]) == 3 + 3  # three dimensions, three slices


@pytest.fixture
def nameless(spark, sf_dir, tmp_path):
    """Tables in which some parts and customers lack a name, and some are there twice."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    lost = lambda c, key, n: F.when(F.col(key) % n != 0, F.col(c))
    part = t("part").withColumns({"p_type": lost("p_type", "p_partkey", 3), "p_name": lost("p_name", "p_partkey", 5)})
    people = t("customer").withColumns({"c_name": lost("c_name", "c_custkey", 2), "c_mktsegment": lost("c_mktsegment", "c_custkey", 3)})
    tables = {
        "part": part.unionByName(part.where("p_partkey % 7 = 0").withColumn("p_name", F.lit("zz"))),
        "customer": people.unionByName(people.where("c_custkey % 5 = 0").withColumn("c_mktsegment", F.lit(" a  b "))),
        "nation": t("nation").withColumn("n_name", lost("n_name", "n_nationkey", 4)),
    } | {name: t(name) for name in ("region", "orders", "lineitem")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_models_without_names_are_those_of_silver(spark, nameless):
    want, found = Warehouse(spark, queries.silver(spark, nameless)), queries.sold(spark, nameless)
    assert want["stg_sales"].where("category is null").count() > 0 and want["stg_sales"].where("customer_name is null").count() > 0
    for model in ("stg_sales", "stg_products", "stg_customers", "int_sales_unified", "dim_customer"):
        same = [x for x in want[model].columns if x in found[model].columns]
        assert rows_of(found[model].select(*same)) == rows_of(want[model].select(*same)), model
    assert "category" in found["stg_products"].columns and not {"category", "city", "region"} & set(found["int_sales_unified"].columns)


def test_names_are_met_after_the_aggregation(spark, sf_dir, unbroadcast):
    """Sales are gathered by hash, as their aggregates hold no text: names follow from the product or customer."""
    w = queries.sold(spark, sf_dir)
    for model in ("stg_products", "stg_customers", "dim_customer"):
        assert not re.findall(r"SortAggregate\(key=\[(?:product|customer)_id", plan(w[model])), model


@pytest.mark.parametrize("query", ["incomplete_days", "daily_accuracy", "completeness"])
def test_checks_of_some_days_write_no_fact(spark, sf_dir, tmp_path, monkeypatch, query):
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    queries.QUERIES[query](spark, sf_dir)
    assert "fact" not in {p.name.split("-")[0] for p in tmp_path.iterdir()}


def test_slices_hold_each_row_once(spark):
    df = spark.range(1000).select("id", F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"))
    for column, parts in (("id", 1), ("id", 7), ("day", 6), ("day", 90)):
        found = [df.where(some).count() for some in scratch.slices(df, F.col(column), parts)]
        assert sum(found) == 1000 and max(found) <= 1000 / min(parts, 40) * 1.6
    assert len(scratch.slices(df.limit(0), F.col("id"), 5)) == 1


def test_numbers_in_slices(spark):
    df = spark.range(500).select(F.col("id").alias("n"), F.hash("id").alias("tie"))
    some = scratch.slices(df, F.col("n"), 4)
    found = ranged_keys(df, "k", ["n", "tie"], some, without=("tie",))
    assert found.columns == ["k", "n"] and sorted((r.k, r.n) for r in found.collect()) == [(i + 1, i) for i in range(500)]


def test_suites_write_what_they_read(spark, sf_dir):
    """No hash of each sale, which hardly compresses."""
    fact = queries.suite_tables(spark, sf_dir)["fact_sales"]
    assert "sales_key" not in fact.columns and {"date_key", "product_key", "store_key", "net_sales_amount"} < set(fact.columns)


def test_shares_of_groups_are_those_of_all(spark, sf_dir, duck, monkeypatch):
    """Of large tables products are grouped a share at a time: a condition on the key reaches the lines below the groups."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    written, write = {}, registry.stored_parts

    def count(parts, label, root=None):
        written[label] = list(parts)
        return write(written[label], label, root)

    monkeypatch.setattr(registry, "stored_parts", count)
    same_as_sql(queries.QUERIES["check_scd2"](spark, sf_dir), duck, queries.ORACLES["check_scd2"])
    found = [plan(x).split("== Initial Plan ==")[-1] for x in written["int_product_scd2"]]
    assert len(found) == 2 and all("xxhash64" in x.split("HashAggregate")[-1] for x in found)


def test_sales_are_summed_as_they_meet_their_products(spark, sf_dir, duck, tmp_path, monkeypatch):
    """Of large tables too no fact is written, nor dealt by product once more."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    same_as_sql(queries.QUERIES["drill_down_products"](spark, sf_dir), duck, queries.ORACLES["drill_down_products"])
    found = {p.name.split("-")[0] for p in tmp_path.iterdir()}
    assert "sums" in found and "fact" not in found


def test_slices_are_made_once_and_then_deleted(spark, tmp_path, monkeypatch):
    """Rows are written before they are dealt to ranges, so the sample that finds these does not make them again."""
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for x in rows:
            made.add(len(x))
            yield x

    df = spark.range(300).select(F.col("id").alias("n")).mapInPandas(count, "n long")
    found = ranges.ranged(df, ["n"], slices=[F.col("n") < 100, F.col("n") >= 100])
    assert [r.n for r in found.orderBy("_at").collect()] == list(range(300)) and made.value == 600
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"ranges"} and not list(tmp_path.glob("slice-*/*"))


def test_joins_of_the_fact_carry_no_amount_that_follows(spark, sf_dir):
    w = queries.sold(spark, sf_dir)
    found = marts.sales_with_keys(w["int_sales_unified"], w["dim_date"], *[w[f"int_{d}_scd2"].withColumn(f"{d}_key", F.lit(1)) for d in ("product", "store")])
    assert not {"net_amount", "unit_price", "discount_amount"} & set(found.columns)


@pytest.mark.parametrize("query", ["incomplete_days", "daily_accuracy"])
def test_checks_of_some_days_write_keys_of_dimensions_only(spark, sf_dir, duck, tmp_path, monkeypatch, query):
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    same_as_sql(queries.QUERIES[query](spark, sf_dir), duck, queries.ORACLES[query])
    assert not {"int_product_scd2", "int_store_scd2"} & {p.name.split("-")[0] for p in tmp_path.iterdir()}


def test_keys_are_never_broadcast(spark, sf_dir):
    """Millions of keys are a few megabytes in files, and too much for the driver that builds their table."""
    t = lambda name: adapter.table(spark, sf_dir, name)
    found = adapter.lost(t("lineitem"), "l_partkey", t("part"), "p_partkey")
    assert "Broadcast" not in plan(found) and found.isEmpty()
    assert adapter.lost(t("lineitem"), "l_partkey", t("part").where("p_partkey % 2 = 0"), "p_partkey").where("l_partkey % 2 = 0").isEmpty()


def test_days_are_broadcast_and_products_of_large_tables_are_not(spark, sf_dir, duck, tmp_path, monkeypatch):
    """Sales meet their days where they lie; products and stores, of which only what reports read is written, are merged."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    w = queries.reports(spark, sf_dir, written=False, told=True)
    found = plan(marts.fact_for_reports(*[w[x] for x in queries.DIMENSIONS[:-1]]))
    assert found.count("SortMergeJoin") == 2 and "hashpartitioning(sale_date" not in found
    assert not {"unit_price", "product_family"} & set(w["dim_product"].columns) and "store_name" not in w["dim_store"].columns
    for name in ("drill_down_dates", "drill_down_places", "top_products", "bottom_products"):
        same_as_sql(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])


def test_the_daily_table_writes_no_fact(spark, sf_dir, duck, tmp_path, monkeypatch):
    """Of large tables too: days are summed as sales get their keys, and customers are neither made nor told apart."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    same_as_sql(queries.QUERIES["fact_sales_daily"](spark, sf_dir), duck, queries.ORACLES["fact_sales_daily"])
    found = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert not {"fact", "customer_key"} & set(found) and found.count("ranges") == 2 + 3  # two dimensions, three slices


def test_large_merges_go_some_buckets_at_a_time(spark, sf_dir, duck, tmp_path, monkeypatch):
    """Lines are made a range of orders at a time, nothing merged is written twice, and no slice stays."""
    monkeypatch.setattr(adapter, "SLICE_BYTES", adapter.size_of(adapter.table(spark, sf_dir, "lineitem")) // 3 + 1)
    monkeypatch.setattr(partitioned, "AT_ONCE", 1)
    monkeypatch.setitem(scratch._owned, spark.sparkContext.applicationId, [f"file://{tmp_path}"])
    labels, write, merge = [], scratch.stored_parts, []
    monkeypatch.setattr(scratch, "stored_parts", lambda parts, label, root=None: labels.append(label) or write(parts, label, root))
    monkeypatch.setattr(partitioned, "merge_rows", lambda *a, **k: merge.append(0) or merge_rows(*a, **k))
    same_as_sql(queries.QUERIES["silver_merge"](spark, sf_dir), duck, queries.ORACLES["silver_merge"])
    assert labels == ["rows"] * 3 and len(merge) == 8
