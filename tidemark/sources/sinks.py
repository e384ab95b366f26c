"""Sinks (S7-S10). Every sink writes whole partitions of work, never through the driver."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


BATCH = "batch_id"


def full_name(first, last):
    """Both parts with one blank between, which stays when a part is empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def member_rows(accepted: DataFrame) -> DataFrame:
    """Accepted sign-ups as member rows (S7). The stored secret is the confirm value, as a digest."""
    return accepted.select(
        F.col("submission_id").alias("member_id"),
        full_name(F.col("ftname"), F.col("ltname")).alias("member_name"),
        "email",
        F.col("Phonenumber").alias("phone_number"),
        "address",
        "state",
        F.lit(None).cast("int").alias("selling_quantity"),
        F.col("secret_digest").alias("password_digest"),
    )


def contact_rows(accepted: DataFrame) -> DataFrame:
    """Accepted contact records as stored rows."""
    return accepted.select(
        full_name(F.col("firstname"), F.col("lastname")).alias("name"),
        "mailid",
        "subject",
        "description",
    )


def append(df: DataFrame, path: str) -> None:
    """Plain append for batch jobs that run once."""
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder; a replay overwrites just that folder."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batch(spark: SparkSession, path: str, schema: StructType, batch_id: int) -> DataFrame:
    """What one batch has written."""
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")


def read_if_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A stored table, or None while its folder does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """All written batches, or those before one; no rows while nothing is written yet.

    The batch number is a folder name, so the bound prunes folders.
    """
    full = StructType(schema.fields + [StructField(BATCH, LongType(), True)])
    df = read_if_written(spark, path, full)
    if df is None:
        return spark.createDataFrame([], full)
    return df if before is None else df.filter(F.col(BATCH) < before)


def split_outcome(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows (F6, S9); every row is in exactly one."""
    return judged.filter("accepted"), judged.filter("NOT accepted")
