"""Reading inputs by path or by table name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_artifact(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The artifact ``name`` below ``base``, with the columns of all its files."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(f"{base.rstrip('/')}/{name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_names(spark: SparkSession, database: str) -> set[str]:
    return {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
