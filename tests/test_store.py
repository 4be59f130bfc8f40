from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reqmart.session import checkpoint_root, materialise
from reqmart.sources.readers import read_artifact, read_table, table_names
from tests.conftest import rows

LAYOUT = ["p", "r"]


@pytest.fixture
def first(spark):
    return spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("b", "y", 3.0), ("c", None, 9.0)], "p string, r string, v double")


def test_append_grows_the_schema(spark, store, first):
    store.append(first, "t", LAYOUT)
    more = spark.createDataFrame([("new", 4.0, "d")], "extra string, v double, p string")
    store.append(more, "t", LAYOUT)
    got = {tuple(r) for r in store.read("t").select("p", "r", "v", "extra").collect()}
    assert got == {
        ("a", "x", 1.0, None), ("a", "x", 2.0, None), ("b", "y", 3.0, None), ("c", None, 9.0, None),
        ("d", None, 4.0, "new"),
    }


def test_replace_keys_touches_its_partitions_only(spark, store, first):
    store.append(first, "t", LAYOUT)
    keys = spark.createDataFrame([("a",), ("b",), ("z",), ("c",)], "k string").where("k <> 'c'")
    store.replace_keys(first.where("v = 2").withColumn("v", F.lit(20.0)), "t", keys, {"p": "k"}, LAYOUT)
    assert rows(store.read("t"), "p", "v") == [("a", 20.0), ("c", 9.0)]
    # A null partition value is dropped like any other.
    store.replace_keys(first.where("false"), "t", spark.createDataFrame([("c",)], "k string"), {"p": "k"}, LAYOUT)
    assert rows(store.read("t"), "p", "v") == [("a", 20.0)]
    moved = first.where("p = 'a'").withColumn("r", F.lit("it's elsewhere"))
    store.replace_keys(moved, "t", keys, {"p": "k"}, LAYOUT)
    assert rows(store.read("t"), "p", "r") == [("a", "it's elsewhere"), ("a", "it's elsewhere")]


def test_replace_keys_keeps_blank_and_null_partitions(spark, store):
    """As in the drug-mix report, whose layout starts with an optional opportunity."""
    layout, schema = ["opp", "k"], "opp string, k string, v int"
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    first = spark.createDataFrame([("", "a", 1), ("OPP1", "a", 2), (None, "b", 3), ("", "c", 4)], schema)
    store.replace_keys(first, "t", keys, {"k": "key"}, layout)
    second = spark.createDataFrame([("", "a", 10), ("OPP1", "a", 20), (None, "b", 30), ("", "b", 31)], schema)
    store.replace_keys(second, "t", keys, {"k": "key"}, layout)
    assert rows(store.read("t"), "opp", "k", "v") == [
        (None, "a", 10), (None, "b", 30), (None, "b", 31), (None, "c", 4), ("OPP1", "a", 20),
    ]
    store.replace_keys(second.where("v = 20"), "t", keys, {"k": "key"}, layout)
    assert rows(store.read("t"), "k", "v") == [("a", 20), ("c", 4)]


def test_blank_keys_are_replaced(spark, store):
    schema = "k string, v int"
    store.append(spark.createDataFrame([("", 1), (None, 2), ("x", 3)], schema), "t", ["k"])
    keys = spark.createDataFrame([("",)], "key string")
    store.replace_keys(spark.createDataFrame([("", 5)], schema), "t", keys, {"k": "key"}, ["k"])
    assert rows(store.read("t"), "k", "v") == [(None, 5), ("x", 3)]
    store.replace_keys(spark.createDataFrame([], schema), "t", keys, {"k": "key"}, ["k"])
    assert rows(store.read("t"), "k", "v") == [("x", 3)]


def test_replace_keys_of_a_table_in_another_layout(spark, store, first):
    store.append(first, "t", [])
    keys = spark.createDataFrame([("a",)], "k string")
    store.replace_keys(first.where("v = 1").withColumn("w", F.lit(5)), "t", keys, {"p": "k"}, [])
    assert rows(store.read("t"), "p", "v", "w") == [("a", 1.0, 5), ("b", 3.0, None), ("c", 9.0, None)]


@pytest.mark.parametrize("layout", [[], ["p"]])
def test_full_replace_may_read_the_table(store, first, layout):
    store.full_replace(first, "t", layout)
    store.full_replace(store.read("t").where("v > 2"), "t", layout)
    assert rows(store.read("t"), "p", "v") == [("b", 3.0), ("c", 9.0)]
    assert store.names() == {"t"}


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["_fit", "_folder", "_remove"])
def test_a_broken_off_replacement_leaves_the_old_or_the_new_rows(store, first, monkeypatch, step):
    """Of a plain table, wherever it breaks; a repetition completes it."""
    store.append(first, "t", [])
    old, new = rows(store.read("t"), "p", "v"), [("b", 3.0), ("c", 9.0)]

    def broken(*_):
        raise Broken

    with monkeypatch.context() as patch, pytest.raises(Broken):
        patch.setattr(store, step, broken)
        store.full_replace(first.where("v > 2"), "t", [])
    assert rows(store.read("t"), "p", "v") == (new if step == "_remove" else old)
    store.full_replace(first.where("v > 2"), "t", [])
    assert rows(store.read("t"), "p", "v") == new and store.names() == {"t"}


@pytest.mark.parametrize("step", ["_overwrite_partitions", "_drop_partitions"])
def test_a_partitioned_table_is_there_throughout(store, first, monkeypatch, step):
    store.append(first, "t", ["p"])

    def broken(*_):
        raise Broken

    new = first.where("p <> 'a'").withColumn("v", F.lit(7.0))
    with monkeypatch.context() as patch, pytest.raises(Broken):
        patch.setattr(store, step, broken)
        store.full_replace(new, "t", ["p"])
    assert ("a", 1.0) in rows(store.read("t"), "p", "v")
    store.full_replace(new, "t", ["p"])
    assert rows(store.read("t"), "p", "v") == [("b", 7.0), ("c", 7.0)]


def test_a_table_may_take_another_layout(store, first):
    store.append(first, "t", [])
    store.full_replace(store.read("t").withColumn("w", F.lit(1)), "t", ["r"])
    assert rows(store.read("t"), "p", "w") == [("a", 1), ("a", 1), ("b", 1), ("c", 1)]


def test_declared_table(spark, store):
    store.create_declared("t", "a string, n int, d string", ["d"])
    df = spark.createDataFrame([("2024-01-01", "7", "x")], "d string, n string, a string")
    store.insert_declared(df, "t")
    assert rows(store.read("t"), "a", "n", "d") == [("x", 7, "2024-01-01")]
    store.replace_declared(df.withColumn("n", F.lit("8")), "t", "a string, n int, d string", ["d"])
    assert rows(store.read("t"), "a", "n", "d") == [("x", 8, "2024-01-01")]
    store.delete_rows("t")
    assert store.read("t").isEmpty() and store.exists("t")


def test_write_once_and_drop(store, first):
    assert store.read_if_exists("t") is None
    store.write_once(first, "t")
    store.write_once(first.where("false"), "t")
    assert store.read("t").count() == 4
    store.drop("t")
    assert not store.exists("t")


def test_readers(spark, store, first, tmp_path):
    first.write.parquet(f"{tmp_path}/art/part=1")
    first.withColumn("w", F.lit(1)).write.parquet(f"{tmp_path}/art/part=2")
    assert set(read_artifact(spark, str(tmp_path), "art").columns) == {"p", "r", "v", "w", "part"}
    store.append(first, "t", [])
    assert read_table(spark, store.table("t")).count() == 4
    assert table_names(spark, store.database) == {"t"}


def test_materialised_rows_stay_as_they_were(spark, store, first):
    store.append(first, "t", [])
    kept = materialise(store.read("t"))
    store.delete_rows("t")
    assert kept.count() == 4
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert kept.inputFiles()[0].removeprefix("file://").startswith(checkpoint_root(spark))


def test_few_rows_over_many_partitions_are_written_by_several_tasks(spark, store):
    rows = spark.range(20000).select((F.col("id") % 200).cast("string").alias("p"), F.lit("x").alias("r"), F.col("id").cast("double").alias("v"))
    store.append(rows, "spread", LAYOUT)
    files = store.read("spread").select(F.substring(F.col("_metadata.file_name"), 1, 10).alias("task")).distinct()
    assert files.count() > 1
    assert store.read("spread").count() == 20000


def test_many_partitions_are_listed_by_few_tasks(spark, store):
    rows = spark.range(300).select(F.col("id").cast("string").alias("p"), F.lit("x").alias("r"), F.col("id").cast("double").alias("v"))
    store.append(rows, "many", LAYOUT)
    spark.catalog.refreshTable(store.table("many"))
    spark.sparkContext.setJobGroup("listed", "")
    try:
        assert store.read("many").where("v >= 0").count() == 300
    finally:
        spark.sparkContext.setJobGroup("others", "")
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("listed") for s in tracker.getJobInfo(job).stageIds}
    assert 0 < max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 128


def test_partitions_are_compared_only_where_some_were_stored(spark, store, first, monkeypatch):
    store.append(first, "t", LAYOUT)
    dropped = []
    monkeypatch.setattr(store, "_drop_partitions", lambda partitions, name: dropped.append(name))
    new, keys = first.where("p = 'a'").withColumn("p", F.lit("n")), spark.createDataFrame([("n",)], "k string")
    store.replace_keys(new, "t", keys, {"p": "k"}, LAYOUT)
    assert dropped == [] and store.read("t").where("p = 'n'").count() == 2
    store.replace_keys(new.where("v = 1"), "t", keys, {"p": "k"}, LAYOUT)
    assert dropped == ["t"] and store.read("t").where("p = 'n'").count() == 1
