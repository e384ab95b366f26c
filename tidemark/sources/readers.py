"""Sources (S1-S6): market snapshot files, stored tables and form records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import CORRUPT, MARKET, MARKET_WITH_CORRUPT


def read_market(spark: SparkSession, path: str | list[str], array_files: bool = True) -> DataFrame:
    """One row per asset of a snapshot.

    ``array_files`` reads files that hold one JSON array each; such a file is one task.
    For large snapshots use JSON lines (``False``), which Spark splits.
    """
    return read_market_checked(spark, path, array_files).filter(~is_corrupt()).select(*MARKET.names)


def read_market_checked(
    spark: SparkSession, path: str | list[str], array_files: bool = True
) -> DataFrame:
    """As :func:`read_market`, but with unreadable records kept and marked."""
    return (
        spark.read.schema(MARKET_WITH_CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", array_files)
        .json(path)
    )


def is_corrupt():
    """Broken JSON, or an object without an id such as an error body."""
    return F.col(CORRUPT).isNotNull() | F.col("id").isNull()


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table (members, admins, contacts) kept as parquet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The same table from a database; give ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` so that more than one task reads it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_forms(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "json", **options: str
) -> DataFrame:
    """Submitted form records with every field as nullable text."""
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def stream_forms(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "json",
    files_per_trigger: int = 1000,
    **options: str,
) -> DataFrame:
    """The same records as they arrive in a folder."""
    return (
        spark.readStream.schema(schema)
        .options(**options)
        .option("maxFilesPerTrigger", files_per_trigger)
        .format(fmt)
        .load(path)
    )
