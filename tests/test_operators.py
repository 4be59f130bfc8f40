from __future__ import annotations

from pyspark.sql import functions as F

from reqmart.operators import aggregates, checks, keys, lookups, reshape
from tests.conftest import rows

KEYS = ["a", "b"]


def test_new_keys_compares_parts_not_text(spark):
    current = spark.createDataFrame([("a", "bc"), ("a", "bc"), ("ab", "c"), ("x", None)], "a string, b string")
    seen = spark.createDataFrame([("ab", "c"), (None, None)], "a string, b string")
    assert rows(keys.new_keys(current, seen, KEYS)) == [("a", "bc")]
    assert rows(keys.new_keys(current, None, KEYS)) == [("a", "bc"), ("ab", "c")]


def test_restrict_never_multiplies(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    wanted = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert rows(keys.restrict(facts, wanted, {"k": "key"})) == [("a", 1)]


def test_unique_lookup_modes(spark):
    codes = spark.createDataFrame(
        [("c1", "Y"), ("c2", "Y"), ("c2", "N"), ("c3", "N"), ("c3", "N"), ("c4", None)], "code string, flag string"
    )
    assert rows(lookups.unique_lookup(codes, ["code"], ["flag"])) == [("c1", "Y"), ("c4", None)]
    entries = rows(lookups.unique_lookup(codes, ["code"], ["flag"], "entry"))
    assert entries == [("c1", "Y"), ("c2", "N"), ("c2", "Y"), ("c4", None)]


def test_lookups(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "a"), ("l", None)], "k string, v string")
    assert rows(lookups.distinct_lookup(df, ["k", "v"])) == [("k", "a"), ("k", "b"), ("l", None)]
    assert rows(lookups.one_per_key(df, ["k"], ["v"])) == [("k", "a"), ("l", None)]


def test_explode_list(spark):
    df = spark.createDataFrame([("p", "1_2_3"), ("q", "4"), ("r", None), ("s", "")], "p string, ids string")
    assert rows(reshape.explode_list(df, "ids")) == [("p", "1"), ("p", "2"), ("p", "3"), ("q", "4"), ("s", "")]


def test_unpivots_keep_nulls(spark):
    df = spark.createDataFrame([("k", 1.0, None, "u", "v")], "k string, x double, y double, n1 string, n2 string")
    assert rows(reshape.unpivot_measures(df, ["k"], ["x", "y"])) == [("k", "x", 1.0), ("k", "y", None)]
    groups = {"1": ["x", "n1"], "2": ["y", "n2"]}
    assert rows(reshape.unpivot_groups(df, ["k"], "grp", groups, ["val", "nm"])) == [
        ("k", "1", 1.0, "u"), ("k", "2", None, "v"),
    ]


def test_pick_by_name_equals_unpivot_and_join(spark):
    df = spark.createDataFrame(
        [("k1", "x", 1.0, 2.0), ("k2", "y", 3.0, 4.0), ("k3", "z", 5.0, 6.0)], "k string, name string, x double, y double"
    )
    picked = df.select("k", reshape.pick_by_name(F.col("name"), ["x", "y"]).alias("v"))
    assert rows(picked) == [("k1", 1.0), ("k2", 4.0), ("k3", None)]
    long = reshape.unpivot_measures(df, ["k", "name"], ["x", "y"]).where("name = col0")
    assert rows(long, "k", "col1") == [("k1", 1.0), ("k2", 4.0)]


def test_conditional_sums(spark):
    df = spark.createDataFrame(
        [("k", 2.0, "in", "out"), ("k", 3.0, "also", None), ("k", None, "in", "in")], "k string, v double, c string, d string"
    )
    assert rows(reshape.conditional_sums(df, ["k"], "v", ["c", "d"], ["in", "also"])) == [("k", 5.0, 0.0)]


def test_latest_per_key_keeps_ties_and_ranks_nulls_last(spark):
    df = spark.createDataFrame(
        [
            ("a", 2, 1, "x"), ("a", 2, 1, "y"), ("a", 2, None, "z"), ("a", None, 9, "w"),
            ("n", None, None, "only"), (None, 1, 1, "nokey"), (None, 2, 1, "nokey2"),
        ],
        "k string, t int, u int, v string",
    )
    latest = aggregates.latest_per_key(df, ["k"], ["t", "u"])
    assert rows(latest, "k", "v") == [(None, "nokey2"), ("a", "x"), ("a", "y"), ("n", "only")]
    ranked = df.selectExpr("*", "rank() over (partition by k order by t desc, u desc) r").where("r = 1")
    assert rows(latest, "k", "v") == rows(ranked, "k", "v")
    single = aggregates.latest_per_key(df, ["k"], ["t"])
    ranked = df.selectExpr("*", "rank() over (partition by k order by t desc) r").where("r = 1")
    assert rows(single, "k", "v") == rows(ranked, "k", "v")


def test_group_totals_equal_window_totals(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, None), ("b", None)], "k string, v double")
    totals = {"total": F.sum("v"), "mean": F.avg("v")}
    got = aggregates.with_group_totals(df, ["k"], totals, ["k", "v"])
    windowed = df.selectExpr("k", "v", "sum(v) over (partition by k) total", "avg(v) over (partition by k) mean")
    assert rows(got) == rows(windowed)


def test_unions(spark):
    one = spark.createDataFrame([(1, "a")], "n int, t string")
    other = spark.createDataFrame([("a", 1), ("b", 2)], "t string, n int")
    assert rows(aggregates.union_all([one, other])) == [(1, "a"), (1, "a"), (2, "b")]
    assert rows(aggregates.union_distinct([one, other])) == [(1, "a"), (2, "b")]


def test_counts_leave_out_incomplete_keys(spark):
    source = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("c", "2")], "a string, b string")
    report = spark.createDataFrame([("a", "1"), ("c", "2"), ("d", None)], "a string, b string")
    assert checks.distinct_key_count(source, KEYS, "n").first()["n"] == 2
    assert rows(checks.reconcile(source, report, KEYS)) == [(2, 2, True)]
    assert rows(checks.reconcile(source, report.where("a = 'a'"), KEYS)) == [(2, 1, False)]
