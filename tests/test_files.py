"""Raw files in, scores of files and stages out."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart.operators import checks, scores
from tidemart.plans import marts
from tidemart.plans.registry import Warehouse
from tidemart.config import Settings
from tidemart.sources import bronze, files, generator, warehouse

AT = datetime(2024, 1, 15, 3)


@pytest.fixture
def csvs(tmp_path, spark):
    rows = bronze.sample_rows(spark).toPandas()
    (tmp_path / "in").mkdir()
    for i in range(3):
        rows.rename(columns={"row_id": "Row ID", "sub_category": "Sub-Category"}).to_csv(tmp_path / f"in/f{i}.csv", index=False)
    return tmp_path


def test_ingest_is_idempotent(spark, csvs):
    first = bronze.ingest(spark, f"{csvs}/in", f"{csvs}/bronze", AT)
    assert bronze.ingest_status(first).first().status == "success" and first.where("status = 'uploaded'").count() == 3
    (csvs / "in/f0.csv").write_text("a\n1\n")
    again = bronze.ingest(spark, f"{csvs}/in", f"{csvs}/bronze", AT)
    assert again.where("status = 'skipped'").count() == 3 and [r.file_name for r in again.where("changed").collect()] == ["f0.csv"]
    assert bronze.listing(spark, f"{csvs}/bronze").first().files == 3
    assert bronze.listing(spark, f"{csvs}/nowhere").first().status == "error"
    bronze.write_manifest(first, f"{csvs}/bronze")
    assert spark.read.json(f"{csvs}/bronze/_metadata/upload_log").count() == 3
    assert bronze.ingest_status(first.limit(0)).first().status == "no_files"


def test_ingest_takes_one_file_of_a_name(spark, csvs):
    (csvs / "in/deeper").mkdir()
    (csvs / "in/deeper/f1.csv").write_text("b\n2\n")
    out = bronze.ingest(spark, f"{csvs}/in", f"{csvs}/bronze", AT)
    assert sorted((r.file_name, r.status, r.changed) for r in out.collect()) == [("f0.csv", "uploaded", False), ("f1.csv", "skipped", True), ("f1.csv", "uploaded", False), ("f2.csv", "uploaded", False)]
    assert (csvs / "bronze/year=2024/month=01/day=15/f1.csv").read_text() == "b\n2\n"  # that with the least path
    assert bronze.ingest_status(out).first().uploaded == 3 and out.count() == 4  # reading again copies nothing


def test_ingest_goes_on_after_an_error(spark, csvs, monkeypatch):
    assert bronze._copied(f"file://{csvs}/in/f0.csv", f"file://{csvs}/out/x/f0.csv") is None and (csvs / "out/x/f0.csv").exists()
    assert "nowhere" in bronze._copied(f"file://{csvs}/nowhere.csv", f"file://{csvs}/out/nowhere.csv")


def test_read_raw(spark, csvs):
    bronze.ingest(spark, f"{csvs}/in", f"{csvs}/bronze", AT).count()
    df = files.read_raw(spark, f"{csvs}/bronze", "2024-01-15_x", date(2024, 2, 2), AT)
    assert df.count() == 6 and {"row_id", "sub_category", "source_file", "batch_id"} <= set(df.columns)
    assert {r.source_file for r in df.collect()} == {"f0.csv", "f1.csv", "f2.csv"}
    back = files.read_raw(spark, f"{csvs}/bronze", "other", date(2024, 2, 2), AT, fallback=f"{csvs}/in")
    assert back.count() == 6 and "row_id" in back.columns
    assert files.read_day(spark, f"{csvs}/bronze", date(2024, 1, 15)).count() == 6
    assert df.where("postal_code = '08701'").count() == 6


def test_event_files(spark, tmp_path):
    generator.generate(spark, 20, date(2024, 1, 1)).write.json(f"{tmp_path}/sales_events")
    assert files.is_event_path(f"{tmp_path}/sales_events") and not files.is_event_path("x") and files.is_event_path("x", "json")
    assert files.read_events(spark, f"{tmp_path}/sales_events").count() == 20
    now = datetime(2020, 1, 1)
    assert files.modified_between(spark, f"{tmp_path}/sales_events", now, datetime(2100, 1, 1)).count() == 20
    assert files.modified_between(spark, f"{tmp_path}/sales_events", datetime(2019, 1, 1), now).count() == 0


def test_file_score(spark):
    good = bronze.sample_rows(spark)
    r = scores.file_score(good).first()
    assert r.field_score == 100 and r.schema_valid and r.missing == []
    poor = scores.file_score(good.select("order_id", F.lit(None).cast("string").alias("zz"))).first()
    assert not poor.schema_valid and "zz is mostly null" in poor.issues and poor.overall_score < 70
    report = scores.batch_report(scores.file_score(good, "a").union(scores.file_score(good, "b"))).first()
    assert report.total_files == 2 and report.grade in ("excellent", "good", "acceptable")
    with pytest.raises(ValueError, match="asked for"):
        scores.gate(scores.file_score(good.select("order_id")))


def test_event_score(spark):
    lines = spark.createDataFrame([('{"order_id":null,"customer_id":"a","product_id":"b","sales":1,"quantity":2}',), ('{"order_id":"x"}',), ("no",)], "value string")
    assert [(r.score, r.is_valid) for r in scores.event_score(lines).collect()] == [(100.0, True), (20.0, False), (0.0, False)]


def test_stage_scores(spark, sf_dir):
    events = generator.generate(spark, 300, date(2024, 1, 1))
    stream = {r.check_name: r.passed for r in scores.validate_stream(events, window_seconds=2).collect()}
    assert stream["schema"] and stream["completeness"] and stream["throughput"] and stream["time_range"]
    raw = scores.validate_raw(bronze.sample_rows(spark))
    assert raw.count() == 6
    summary = scores.run_summary(raw).first()
    assert summary.checks == 6 and 0 <= summary.mean_score <= 1
    spark.range(3).createOrReplaceTempView("some_table")
    found = {r.check_name: r.passed for r in scores.validate_warehouse(spark, {"some_table": ("id",), "no_table": ()}).collect()}
    assert found == {"some_table": True, "no_table": False}


def test_checks_find_faults(spark):
    df = spark.createDataFrame([(1, "a@b.co", date(2024, 1, 1)), (2, "nope", None), (2, None, date(2024, 2, 1))], "k int, mail string, d date")
    assert checks.unique(df, "k").count() == 1
    assert checks.valid_email_format(df, "mail").count() == 1
    assert checks.valid_date_range(df, "d", date(2024, 1, 1), date(2024, 1, 31)).count() == 2
    assert checks.sequential_dates(df, "d").first().day_gap == 31
    assert checks.null_rate(df, "mail", 0.3).count() == 1 and checks.null_rate(df, "mail", 0.4).count() == 0
    assert checks.source_freshness(df.select(F.col("d").cast("timestamp").alias("t")), "t", datetime(2024, 2, 1, 3)).first().status == "warn"
    fused = {r.rule: r.violation_count for r in checks.fused(df, {"no_mail": F.col("mail").isNull(), "two": F.col("k") == 2}).collect()}
    assert fused == {"no_mail": 1, "two": 2}


def test_store_and_views(spark, tmp_path, sf_dir):
    from tidemart.queries import silver

    w = Warehouse(spark, silver(spark, sf_dir).persist(), keep=("stg_sales",))
    stored = warehouse.store(w, f"{tmp_path}/gold", ["stg_sales", "dim_date", "dim_product"])
    assert set(stored) == {"dim_date", "dim_product"} and spark.table("stg_sales").count() > 0
    assert warehouse.external_table(spark, "gold_products", stored["dim_product"]).count() == w["dim_product"].count()
    n = w.made["silver"].count()
    assert warehouse.append(w.made["silver"], f"{tmp_path}/export", rows_per_part=1000, most_parts=3) and not warehouse.append(w.made["silver"].limit(0), f"{tmp_path}/export")
    out = spark.read.parquet(f"{tmp_path}/export")
    assert out.columns == [x for x, _ in warehouse.EXPORTED] and len(out.columns) == 26 and out.count() == n and len(out.inputFiles()) == min(3, n // 1000)
    assert dict(out.dtypes)["PARTITION_DATE"] == "date" and out.where("STORE_ID not like 'CUST-%' or TOTAL_PRICE <> SALES").count() == 0
    assert len(warehouse.export_columns(w.made["silver"], short=True).columns) == 22
    assert [warehouse.parts_for(x) for x in (0, 4999, 12_000)] == [1, 1, 2]
    spark.sql("drop table gold_products")
    assert spark.read.parquet(stored["dim_product"]).count() == w["dim_product"].count()
    assert warehouse.incremental(spark.range(10), spark.range(4), "id").count() == 6 and warehouse.incremental(spark.range(10), spark.range(0), "id").count() == 10
    assert warehouse.schema_name("prod", "marts") == "marts" and warehouse.schema_name("dev", "marts") == "analytics_marts"
    w.release()


def test_scratch_is_deleted(spark, tmp_path, monkeypatch):
    from tidemart.sources import scratch

    before = scratch.shared_dir(spark)
    with scratch.Scratch(spark) as owner:
        assert scratch.stored(spark.range(5), "some").count() == 5
        folder = owner.path.removeprefix("file://")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and scratch.shared_dir(spark) == before


@pytest.mark.parametrize(("master", "fine"), [("local[4]", True), ("spark://host:7077", False), ("yarn", False)])
def test_shared_folder_of_a_cluster_must_be_set(master, fine):
    from types import SimpleNamespace

    from tidemart.sources import scratch

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, applicationId="app"))
    if fine:
        assert scratch.shared_dir(session) == scratch.shared_dir(session)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_dir(session)


def test_calendar_flags(spark):
    w = Warehouse(spark, None, Settings(spine_start=date(2024, 1, 1), spine_end=date(2025, 1, 1)))
    days = {r.date_key: r for r in w["dim_date"].collect()}
    assert len(days) == 366 and days[20240704].holiday_name == "Independence Day" and days[20240107].day_name == "Sunday"
    assert (days[20240131].fiscal_year, days[20240131].fiscal_month, days[20240131].fiscal_quarter) == (2023, 12, 4)
    odd = marts.dim_date(spark, w["int_date_spine"], Settings(spine_start=date(2024, 1, 1), spine_end=date(2025, 1, 1), shifted_day_names=True))
    assert odd.where("date_key = 20240107").first().day_name == "Saturday"


def test_report_is_written(spark, tmp_path):
    results = spark.createDataFrame([("raw", "a", True, 1.0, "{}"), ("raw", "b", False, 0.5, "{}")], scores.RESULT)
    scores.write_report(results, f"{tmp_path}/report")
    rows = spark.read.json(f"{tmp_path}/report")
    whole = rows.where("kind = 'summary'").first()
    assert (whole.checks, whole.passed, whole.all_passed, whole.mean_score) == (2, 1, False, 0.75)
    assert {(r.check_name, r.check_passed) for r in rows.where("kind = 'result'").collect()} == {("a", True), ("b", False)}


def test_note_of_a_file_set_aside(spark):
    note = scores.quarantine_record(spark, "a/b.csv", "score too low", 40, AT).first()
    assert tuple(note) == ("a/b.csv", "score too low", 40.0, AT)


def test_keys_and_audit_columns(spark):
    from hashlib import md5

    from tidemart.functions import columns as c

    end = date(2099, 12, 31)
    df = spark.createDataFrame([("a", None, date(2024, 1, 1), end), ("b", 2, date(2024, 1, 1), None)], "x string, y int, since date, till date")
    a, b = df.select(c.plain_key("x", "y").alias("k"), "*").withColumns(c.scd2_audit_columns("since", "till", end, F.lit(AT), run="r")).collect()
    assert [a.k, b.k] == [md5(s).hexdigest().upper() for s in (b"a", b"b2")]
    assert (a.is_current, b.is_current, a.effective_from, a.effective_to) == (True, False, date(2024, 1, 1), end)
    assert (a.created_at, a.updated_at, a.invocation_id, a.target_name) == (AT, AT, "r", "dev")


def test_append_over_jdbc(spark, sf_dir, tmp_path):
    from tidemart.queries import silver

    rows = silver(spark, sf_dir).limit(50).persist()
    url = f"jdbc:derby:{tmp_path}/warehouse;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for _ in range(2):
        assert warehouse.append_jdbc(rows, url, "sales", connections=2, rows_per_part=20, **driver)
    assert not warehouse.append_jdbc(rows.limit(0), url, "sales", **driver)
    back = spark.read.options(**driver).jdbc(url, "sales")
    assert back.columns == [x for x, _ in warehouse.EXPORTED]
    want = warehouse.export_columns(rows)
    assert back.count() == 100 and back.select(want.columns).distinct().exceptAll(want.distinct()).count() == 0
    rows.unpersist()
