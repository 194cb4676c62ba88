"""Scores of raw files and of pipeline stages."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemart.functions.columns import number_text, snake_name
from tidemart.schemas import CANONICAL
from tidemart.sources.scratch import stored

# Thresholds of the scores.
FILE_VALID, EVENT_VALID, MOSTLY_NULL = 70, 90, 50
REQUIRED_EVENT = ("order_id", "customer_id", "product_id", "sales", "quantity")
CRITICAL = ("order_id", "customer_id", "product_id")
RAW_COLUMNS = (
    "order_id", "order_date", "ship_date", "customer_id", "customer_name", "product_id", "product_name", "category",
    "sales", "quantity", "profit",
)


# -- files


def column_counts(df: DataFrame) -> DataFrame:
    """One row: rows, and for each column non-null cells and cells that do not read as numbers; one scan."""
    cells = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    text = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").cast("string").try_cast("double").isNull()).alias(f"t{i}") for i, c in enumerate(df.columns)]
    return df.agg(F.count("*").alias("rows"), *cells, *text)


def file_score(df: DataFrame, name: str = "file") -> DataFrame:
    """(file_name, row_count, field, completeness, consistency and overall scores, schema_valid, missing, extra, issues).

    Field: share of the canonical fields among the headers. Completeness: share of non-null cells. Consistency: ten off
    for each text column whose header is normalised already. Overall: 0.4, 0.3 and 0.3 of them, rounded down.
    """
    headers = {snake_name(c) for c in df.columns}
    missing, extra = sorted(CANONICAL.keys() - headers), sorted(headers - CANONICAL.keys())
    field = 100.0 * (len(CANONICAL) - len(missing)) / len(CANONICAL)
    n, rows = len(df.columns), F.col("rows")
    filled = sum((F.col(f"n{i}") for i in range(n)), F.lit(0))
    whole = F.when(rows > 0, 100.0 * filled / (rows * max(n, 1))).otherwise(0.0)
    raw_same = [i for i, c in enumerate(df.columns) if c.strip().lower().replace(" ", "_") == c]
    texts = sum((F.when(F.col(f"t{i}") > 0, 1).otherwise(0) for i in raw_same), F.lit(0))
    consistent = F.greatest(F.lit(0.0), 100.0 - 10.0 * texts)
    issues = F.array_compact(
        F.array(
            *[F.when((rows > 0) & (F.col(f"n{i}") / rows < 1 - MOSTLY_NULL / 100), f"{c} is mostly null") for i, c in enumerate(df.columns)],
            F.when(F.col("repeated") > 0, F.concat(F.col("repeated").cast("string"), F.lit(" duplicate rows"))),
        )
    )
    repeated = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("repeated"))
    facts = column_counts(df).join(repeated)  # two single rows
    return facts.select(
        F.lit(name).alias("file_name"),
        rows.alias("row_count"),
        F.lit(field).alias("field_score"),
        whole.alias("completeness_score"),
        consistent.alias("consistency_score"),
        F.floor(0.4 * F.lit(field) + 0.3 * whole + 0.3 * consistent).cast("int").alias("overall_score"),
        F.lit(not missing).alias("schema_valid"),
        F.lit(missing).cast("array<string>").alias("missing"),
        F.lit(extra).cast("array<string>").alias("extra"),
        issues.alias("issues"),
    )


def event_score(lines: DataFrame, column: str = "value") -> DataFrame:
    """(event, score, is_valid, missing): which required keys a JSON event has; a null value counts as there."""
    parsed = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    has = lambda k: F.coalesce(F.map_contains_key("_m", k), F.lit(False))
    score = sum((has(k).cast("int") for k in REQUIRED_EVENT), F.lit(0)) * 100 / len(REQUIRED_EVENT)
    missing = F.array_compact(F.array(*[F.when(~has(k), k) for k in REQUIRED_EVENT]))
    return lines.select(F.col(column).alias("event"), parsed.alias("_m")).select("event", score.alias("score"), (score >= EVENT_VALID).alias("is_valid"), missing.alias("missing"))


def batch_report(scores: DataFrame) -> DataFrame:
    """(total, valid and invalid files, mean score, grade) of file scores."""
    valid = F.col("schema_valid") & (F.col("overall_score") >= FILE_VALID)
    out = scores.agg(F.count("*").alias("total_files"), F.count_if(valid).alias("valid_files"), F.avg("overall_score").alias("mean_score"))
    out = out.withColumn("invalid_files", F.col("total_files") - F.col("valid_files"))
    mean, bad = F.col("mean_score"), F.col("invalid_files")
    grade = F.when((mean >= 90) & (bad == 0), "excellent").when((mean >= 80) & (bad <= 1), "good").when(mean >= 70, "acceptable").otherwise("poor")
    return out.withColumn("grade", grade)


def gate(scores: DataFrame, least: float = FILE_VALID) -> float:
    """The mean score, or an error if it is too low."""
    mean = scores.agg(F.avg("overall_score")).first()[0]
    if mean is None or mean < least:
        raise ValueError(f"the files score {mean}; {least} is asked for")
    return mean


def quarantine_record(spark: SparkSession, path: str, reason: str, score: float, at: datetime) -> DataFrame:
    """What is noted of a file that is set aside; the file stays where it is."""
    return spark.createDataFrame([(path, reason, float(score), at)], "path string, reason string, score double, quarantined_at timestamp")


# -- stages: (stage, check_name, passed, score, details)

RESULT = "stage string, check_name string, passed boolean, score double, details string"


def _details(facts: DataFrame, names: tuple[str, ...]) -> Column:
    """The facts named as JSON without nulls; numbers are written without exponents of Java's kind."""
    kinds = dict(facts.dtypes)
    # what JSON cannot say of a number, NaN or infinity, is quoted
    number = lambda n: F.when(F.isnan(n) | (F.abs(n) == float("inf")), F.concat(F.lit('"'), F.col(n).cast("string"), F.lit('"'))).otherwise(number_text(n))
    value = lambda n: number(n) if kinds[n] == "double" else F.col(n).cast("string")
    parts = F.array_compact(F.array(*[F.concat(F.lit(f'"{n}":'), value(n)) for n in names]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def _result(facts: DataFrame, stage: str, name: str, passed, score, *details: str) -> DataFrame:
    return facts.select(
        F.lit(stage).alias("stage"),
        F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.coalesce(score.cast("double"), F.lit(0.0)).alias("score"),
        _details(facts, details).alias("details"),
    )


def _together(results: list[DataFrame]) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _has_columns(df: DataFrame, stage: str, wanted: tuple[str, ...]) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    row = (stage, "schema", not missing, 1 - len(missing) / len(wanted), json.dumps({"missing": missing}))
    return df.sparkSession.createDataFrame([row], RESULT)


def validate_raw(df: DataFrame, wanted: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """Columns, null rates (10 % overall, none in keys), types, business rules (5 %), duplicates (5 %) and outliers (10 %)."""
    stage, has = "raw", [c for c in wanted if c in df.columns]
    schema = _has_columns(df, stage, wanted)
    number = lambda c: F.col(c).cast("string").try_cast("double")
    numbers = [c for c in ("sales", "quantity", "profit") if c in has]
    bad = F.lit(False)
    for c in numbers:
        if c != "profit":
            bad = bad | (number(c) <= 0)
    keys = [c for c in CRITICAL if c in has]
    facts = df.agg(
        F.count("*").alias("rows"),
        (sum((F.count_if(F.col(c).isNull()) for c in has), F.lit(0)) / (F.count("*") * len(has))).alias("null_rate"),
        sum((F.count_if(F.col(c).isNull()) for c in keys), F.lit(0)).alias("null_keys"),
        sum((F.count_if(F.col(c).isNotNull() & number(c).isNull()) for c in numbers), F.lit(0)).alias("bad_types"),
        (F.count_if(bad) / F.count("*")).alias("violation_rate"),
    )
    repeated = df.groupBy(*df.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("repeated"))
    from tidemart.plans.metrics import iqr_outliers

    out = [
        schema,
        _result(facts, stage, "completeness", (F.col("null_rate") <= 0.1) & (F.col("null_keys") == 0), 1 - F.col("null_rate"), "null_rate", "null_keys"),
        _result(facts, stage, "types", F.col("bad_types") == 0, F.when(F.col("bad_types") == 0, 1.0).otherwise(0.0), "bad_types"),
        _result(facts, stage, "business_rules", F.col("violation_rate") <= 0.05, 1 - F.col("violation_rate"), "violation_rate"),
        _result(
            facts.join(repeated).withColumn("duplicate_rate", F.col("repeated") / F.col("rows")),  # two single rows
            stage, "duplicates", F.col("duplicate_rate") <= 0.05, 1 - F.col("duplicate_rate"), "duplicate_rate",
        ),
    ]
    if "sales" in has:
        rate = iqr_outliers(stored(df.select(number("sales").alias("sales")), "sales"), "sales")  # which reads it several times
        out.append(_result(rate, stage, "outliers", F.col("outlier_rate") <= 0.1, 1 - F.col("outlier_rate"), "q1", "q3", "outlier_rate"))
    return _together(out)


def validate_stream(
    df: DataFrame, at: str = "event_timestamp", required: tuple[str, ...] = REQUIRED_EVENT, key: str = "order_id",
    window_seconds: float = 60, rate: float = 100, most_null: float = 0.05, hours: float = 24,
) -> DataFrame:
    """Required fields, null rate, repeated keys, span of time and throughput."""
    stage = "stream"
    has = [c for c in required if c in df.columns]
    t = F.col(at).cast("timestamp")
    facts = df.agg(
        F.count("*").alias("rows"),
        (sum((F.count_if(F.col(c).isNull()) for c in has), F.lit(0)) / (F.count("*") * max(1, len(has)))).alias("null_rate"),
        (F.count(key) - F.countDistinct(key)).alias("repeated"),
        ((F.unix_micros(F.max(t)) - F.unix_micros(F.min(t))) / 3.6e9).alias("hours"),
    ).withColumn("rate", F.col("rows") / window_seconds)
    return _together(
        [
            _has_columns(df, stage, required),
            _result(facts, stage, "completeness", F.col("null_rate") <= most_null, 1 - F.col("null_rate"), "null_rate"),
            _result(facts, stage, "duplicates", F.col("repeated") == 0, 1 - F.col("repeated") / F.col("rows"), "repeated"),
            _result(facts, stage, "time_range", F.col("hours") <= hours, F.when(F.col("hours") <= hours, 1.0).otherwise(0.0), "hours"),
            _result(facts, stage, "throughput", F.col("rate") >= rate, F.least(F.lit(1.0), F.col("rate") / rate), "rate"),
        ]
    )


def validate_etl(before: DataFrame, after: DataFrame, seconds: float, wanted: tuple[str, ...] = CRITICAL, retained: float = 0.9, rate: float = 1000) -> DataFrame:
    """Retention, output columns, ``unit_price * quantity`` against sales, and throughput."""
    stage = "etl"
    off = F.abs(F.col("unit_price") * F.col("quantity") - F.col("sales"))
    facts = before.agg(F.count("*").alias("rows_in")).join(after.agg(F.count("*").alias("rows_out"), F.count_if(off <= 0.01).alias("right")))  # two single rows
    facts = facts.withColumns(
        {
            "retention": F.col("rows_out") / F.nullif(F.col("rows_in"), F.lit(0)),
            "accuracy": F.col("right") / F.nullif(F.col("rows_out"), F.lit(0)),
            "rate": F.col("rows_in") / max(seconds, 1e-9),
        }
    )
    return _together(
        [
            _result(facts, stage, "retention", F.col("retention") >= retained, F.least(F.lit(1.0), "retention"), "rows_in", "rows_out"),
            _has_columns(after, stage, wanted),
            _result(facts, stage, "calculation", F.col("accuracy") >= 0.95, F.col("accuracy"), "accuracy"),
            _result(facts, stage, "throughput", F.col("rate") >= rate, F.least(F.lit(1.0), F.col("rate") / rate), "rate"),
        ]
    )


def validate_warehouse(spark: SparkSession, tables: dict[str, tuple[str, ...]]) -> DataFrame:
    """Whether tables or views exist, have rows and no null in the columns named."""
    out = []
    for name, keys in tables.items():
        if not spark.catalog.tableExists(name):
            out.append(spark.createDataFrame([("warehouse", name, False, 0.0, json.dumps({"exists": False}))], RESULT))
            continue
        facts = spark.table(name).agg(F.count("*").alias("rows"), sum((F.count_if(F.col(k).isNull()) for k in keys), F.lit(0)).alias("nulls"))
        good = (F.col("rows") > 0) & (F.col("nulls") == 0)
        out.append(_result(facts, "warehouse", name, good, F.when(good, 1.0).otherwise(0.0), "rows", "nulls"))
    return _together(out)


def run_summary(results: DataFrame) -> DataFrame:
    """(checks, passed, all_passed, mean_score) over stages."""
    return results.agg(
        F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.coalesce(F.min("passed"), F.lit(True)).alias("all_passed"), F.avg("score").alias("mean_score")
    )


def write_report(results: DataFrame, path: str) -> None:
    """The summary and its results as JSON."""
    summary = run_summary(results).withColumn("kind", F.lit("summary"))
    summary.unionByName(results.withColumn("kind", F.lit("result")).withColumnRenamed("passed", "check_passed"), allowMissingColumns=True).coalesce(1).write.mode(
        "overwrite"
    ).json(path)
