"""The report store: managed tables of one schema, and the ways a run writes them.

No write overwrites what it reads, and each can be repeated after a lost executor or a failed run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reqmart.operators.keys import restrict, same_key
from reqmart.session import materialise, remove, settings

DROPPED_AT_ONCE = 200
#: A partitioned write opens a file per partition in each task. Few rows over many partitions are still spread
#: over the cores, instead of being coalesced by size into one task that writes every partition in turn.
SPREAD_WRITES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


class ReportStore:
    """Tables of the schema ``database``, kept below ``location`` if one is given."""

    def __init__(
        self, spark: SparkSession, database: str = "reporting", location: str | None = None, fmt: str = "parquet"
    ):
        self.spark, self.database, self.fmt = spark, database, fmt
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def names(self) -> set[str]:
        return {t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary}

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def read_if_exists(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")

    def delete_rows(self, name: str) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.table(name)}")

    def append(self, df: DataFrame, name: str, partition_by: list[str] = ()) -> None:
        """Add rows; columns the table lacks are added to it, columns the rows lack are null."""
        if not self.exists(name):
            self._create(df, name, partition_by)
            return
        self._grow(name, df)
        with settings(self.spark, SPREAD_WRITES):
            self._fit(df, name).write.insertInto(self.table(name))

    def replace_keys(
        self, df: DataFrame, name: str, keys: DataFrame, on: dict[str, str], partition_by: list[str]
    ) -> None:
        """Make ``df`` the only rows of the given keys; other keys keep theirs.

        ``on`` maps the table's key columns to those of ``keys``. Where the key columns are partition
        columns, only the partitions of these keys are touched: those that get new rows are replaced
        in one write, those that get none are dropped. The rows are computed and written once, straight
        into the table; partitions that still hold a file from before got none. Otherwise the table is
        written anew: then a run costs as much as the whole table, whatever the number of keys. A table
        keeps a blank text of a partition column as null, so blank and null are one value there.
        """
        if not self.exists(name):
            self._create(df, name, partition_by)
            return
        wanted = keys.select(*(F.col(theirs).alias(ours) for ours, theirs in on.items()))
        if not set(on) <= set(partition_by):
            kept = self.read(name).join(wanted, list(on), "left_anti")
            self.full_replace(kept.unionByName(df, allowMissingColumns=True), name, partition_by)
            return
        wanted = _as_stored(wanted, list(on))
        incomplete = wanted.where(reduce(Column.__or__, (F.col(c).isNull() for c in on))).distinct()
        incomplete = incomplete.withColumnsRenamed({c: f"key_{c}" for c in on})

        def of_keys(stored: DataFrame) -> DataFrame:
            complete = restrict(stored, wanted, list(on))
            condition = same_key(stored, incomplete, {c: f"key_{c}" for c in on})
            return complete.union(stored.join(incomplete, condition, "left_semi"))

        self._replace_partitions(_as_stored(df, partition_by), name, of_keys)

    def full_replace(self, df: DataFrame, name: str, partition_by: list[str] = ()) -> None:
        """Make ``df``, which may read the table, its only rows; columns that only the table has become null.

        The table is there at every moment, and the rows are computed and written once. A plain one is written
        to a folder of its own, which the catalog is then told of in one step: readers find the old rows or the
        new ones. Of a partitioned one the new partitions are written first and those left without rows
        dropped after, so readers may meanwhile see old and new partitions side by side; a run that breaks
        off in between is completed by its repetition. Only a table of another layout is dropped before it is
        written; its new rows are computed before that.
        """
        rows = _as_stored(df, partition_by)
        if self.exists(name) and self._partition_columns(name) != list(partition_by):
            rows = materialise(rows)
            self.drop(name)
        if not self.exists(name):
            self._create(rows, name, partition_by)
            return
        if partition_by:
            self._replace_partitions(rows, name, lambda stored: stored)
            return
        self._grow(name, rows)
        before, after = self._folder(name), f"{self._folder()}/{name}__{uuid.uuid4().hex}"
        self._fit(rows, name).write.format(self.fmt).save(after)
        self.spark.sql(f"ALTER TABLE {self.table(name)} SET LOCATION '{after}'")
        self._remove(before)

    def _replace_partitions(self, rows: DataFrame, name: str, affected: Callable[[DataFrame], DataFrame]) -> None:
        """Write the rows over their partitions and drop the affected ones that got none.

        ``affected`` picks rows of the stored partition columns. A partition that was written holds new files
        only, so one that still holds a file from before got no rows.
        """
        partition_by = self._partition_columns(name)

        def files() -> DataFrame:
            """A row per file of the affected partitions; no column of the files is read."""
            stored = self.read(name).select(*partition_by, F.col("_metadata.file_path").alias("file_path"))
            return affected(stored).distinct()

        before = materialise(files())
        self._grow(name, rows)
        self._overwrite_partitions(self._fit(rows, name), name)
        if before.isEmpty():
            return
        left = files().join(before.select("file_path"), "file_path", "left_semi")
        self._drop_partitions(left.select(*partition_by).distinct(), name)

    def write_once(self, df: DataFrame, name: str) -> None:
        if not self.exists(name):
            self._create(df, name, [])

    def create_declared(self, name: str, schema: str, partition_by: list[str]) -> None:
        """Create the table with a declared schema unless it is there."""
        if not self.exists(name):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table(name)} ({schema}) USING {self.fmt} "
                f"PARTITIONED BY ({', '.join(partition_by)})"
            )

    def insert_declared(self, df: DataFrame, name: str) -> None:
        """Insert by the table's declared order and types."""
        with settings(self.spark, SPREAD_WRITES):
            self._fit(df, name).write.insertInto(self.table(name))

    def replace_declared(self, df: DataFrame, name: str, schema: str, partition_by: list[str]) -> None:
        """Full refresh of a declared table: its columns, types and partitions, and these rows only."""
        declared = T.StructType.fromDDL(schema)
        typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared))
        self.full_replace(typed, name, partition_by)

    def _create(self, df: DataFrame, name: str, partition_by: list[str]) -> None:
        """Write a new table. The rows are spread by partition, large partitions over several tasks.

        Files of a run that broke off before its table came into being are removed.
        """
        self._remove(f"{self._folder()}/{name}")
        stored = _as_stored(df, partition_by)
        spread = stored.hint("rebalance", *partition_by) if partition_by else stored
        writer = spread.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with settings(self.spark, SPREAD_WRITES):
            writer.saveAsTable(self.table(name))

    def _fit(self, df: DataFrame, name: str) -> DataFrame:
        """The rows in the table's column order and types, spread by its partitions."""
        have = {c.lower() for c in df.columns}
        declared = self.read(name).schema
        fitted = df.select(
            *(
                (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in declared
            )
        )
        partition_by = self._partition_columns(name)
        return fitted.hint("rebalance", *partition_by) if partition_by else fitted

    def _partition_columns(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.table(name)) if c.isPartition]

    def _grow(self, name: str, df: DataFrame) -> None:
        have = {c.lower() for c in self.read(name).columns}
        extra = [f for f in df.schema if f.name.lower() not in have]
        if extra:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
            self.spark.sql(f"ALTER TABLE {self.table(name)} ADD COLUMNS ({columns})")

    def _overwrite_partitions(self, df: DataFrame, name: str) -> None:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            with settings(self.spark, SPREAD_WRITES):
                df.write.insertInto(self.table(name), overwrite=True)
        finally:
            self.spark.conf.set(setting, before)

    def _drop_partitions(self, partitions: DataFrame, name: str) -> None:
        """Drop catalog partitions, fetched and dropped a few at a time: never the whole list at once."""

        def spec(row) -> str:
            parts = (f"`{c}`={_literal(v)}" for c, v in row.asDict().items())
            return f"PARTITION ({', '.join(parts)})"

        rows = materialise(partitions).toLocalIterator()
        while batch := list(islice(rows, DROPPED_AT_ONCE)):
            specs = ", ".join(spec(row) for row in batch)
            self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS {specs}")

    def _folder(self, name: str | None = None) -> str:
        """Where the schema or one of its tables lies."""
        if name is None:
            place = self.spark.sql(f"DESCRIBE DATABASE {self.database}").where("info_name = 'Location'")
            return place.first()["info_value"]
        place = self.spark.sql(f"DESCRIBE EXTENDED {self.table(name)}").where("col_name = 'Location'")
        return place.first()["data_type"]

    def _remove(self, folder: str) -> None:
        remove(self.spark, folder)


def _as_stored(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Blank texts of partition columns as the null that a table makes of them."""
    blank = {c: F.nullif(F.col(c), F.lit("")) for c, kind in df.dtypes if c in partition_by and kind == "string"}
    return df.withColumns(blank) if blank else df


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return f"'{value}'"
