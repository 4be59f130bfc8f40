"""Session settings the reports rely on, and the place for cut lineage."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot request may hold a third of the facts. Without this, adaptive execution leaves its
    # join partition whole whenever the aggregate that follows could reuse the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where every shuffled partition of a join's smaller side is this small, hash it instead of
    # sorting both sides. Measured at run time, partition by partition.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # Groups that a task hashes before it sorts, where a request's few settings are gathered.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    # Rows joined by a request stay where they are for a join by the request and more. Otherwise wide facts would be
    # shuffled once per join. A hot request is still split, at the price of that shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A table's partition folders are listed by this many tasks at most, several folders each. Spark's own
    # bound is 10,000, which is a task for every partition of most reports.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


#: An execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Rows of a table of any size are kept from a join's shuffle by a Bloom filter of the other side, if that is small
#: (Spark's bound, 10 MB) and filtered by some comparison.
FILTER_BEFORE_JOIN = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above. The broadcast threshold stays the session's own."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; those from before are back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_written_by_runs: list[list[str]] = []


@contextmanager
def run(spark: SparkSession) -> Iterator[SparkSession]:
    """A run with the settings above. Afterwards the session's own are back, and the rows that the run
    materialised are removed, whether it ended well or not."""
    _written_by_runs.append([])
    try:
        with settings(spark, SETTINGS):
            yield spark
    finally:
        for path in _written_by_runs.pop():
            remove(spark, path)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the cluster's own, or one in the warehouse if none is named.

    A named folder is taken at its word, whatever its scheme: ``file:`` may be a mount that all machines share. A
    warehouse that is a folder of one machine serves a local session only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_one_machine = warehouse.startswith("file:") or "://" not in warehouse
    if on_one_machine and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/_checkpoints"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme; one without is of the file system that Spark takes by default."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_removed_at_exit: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        remove(spark, folder)
    except (Py4JError, OSError):  # the session's JVM has ended before
        pass


def scratch_folder(spark: SparkSession) -> str:
    """A new name in the shared folder. Within a run it is removed with the run, elsewhere as the application exits."""
    of_application = f"{checkpoint_root(spark)}/reqmart/{spark.sparkContext.applicationId}"
    if of_application not in _removed_at_exit:
        _removed_at_exit.add(of_application)
        atexit.register(_remove_at_exit, spark, of_application)
    path = f"{of_application}/{uuid.uuid4().hex}"
    if _written_by_runs:
        _written_by_runs[-1].append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a parquet table in the shared folder and read it back.

    Later steps then neither repeat the lineage nor see tables that are not the same any more, and the
    written size lets Spark decide soundly whether the result may be broadcast. Within a run the
    rows go when it ends, elsewhere as the application exits. Its shuffles are of no use once the
    rows are written; their files go with the job.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    with settings(spark, FREE_SHUFFLES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
