"""Shared ground for the training-data operators: tables, scratch space, row helpers."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemart.sources.adapter import table
from tidemart.sources.scratch import shared_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back; ``options`` are the writer's.

    The files outlive any executor, so a lost task re-reads them instead of recomputing what came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete the files of a written table that no later plan reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def field(df: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """The column's type under (maybe) another name, nullable."""
    return T.StructField(name or column, df.schema[column].dataType, True)


def text_of(column: str):
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's argument is, a repeated expression is not."""
    return F.transform(F.array(value), use)[0]


def held_out(doc_id, folds: int, fold: int):
    """Rows whose labels no model may learn from: crc32 of the id as text falls in ``fold``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


__all__ = ["arrow_input", "drop_written", "field", "held_out", "once", "score_of", "scratch_path", "shared_dir", "table", "text_of", "written"]

ARROW_BYTES = 8 << 20  #: of a batch that goes to Python, besides its last row


def arrow_input(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, for a Python function: the session's batches are bounded in bytes, so long texts do not pile up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df.select(*columns) if columns else df


def score_of(score, column: str):
    """``score(text)`` as a column, in Arrow batches."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(score).astype("float64")

    return scored(F.col(column))
