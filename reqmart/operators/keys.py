"""Which requests and scenarios are new, and restricting facts to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reqmart.operators.spread import spread


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The complete keys of ``df``, once each. A key with a null part identifies nothing."""
    return df.select(*keys).dropna(subset=keys).distinct()


def new_keys(current: DataFrame, seen: DataFrame | None, keys: list[str]) -> DataFrame:
    """Complete keys of ``current`` that ``seen`` lacks; all of them if nothing was seen yet.

    Keys are compared column by column, so ``('a', 'bc')`` and ``('ab', 'c')`` stay apart. Both
    sides are made distinct first: a key repeated without end shrinks on the map side, and the
    anti join reuses the partitioning of the two aggregates.
    """
    fresh = distinct_keys(current, keys)
    if seen is not None:
        fresh = fresh.join(distinct_keys(seen, keys), keys, "left_anti")
    return spread(fresh)


def restrict(df: DataFrame, wanted: DataFrame, on: dict[str, str] | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted``; never more rows than ``df`` has.

    Where ``df`` is partitioned by a key and the wanted keys are few enough to be broadcast, only
    their partitions are read. Spark prunes that way only for a side that is filtered by some
    comparison, so text keys are given one that holds for all of them.
    """
    pairs = on if isinstance(on, dict) else {name: name for name in on}
    keys = wanted.select(*(F.col(theirs).alias(ours) for ours, theirs in pairs.items()))
    for name, kind in keys.dtypes:
        if kind == "string":
            keys = keys.where(F.col(name) >= "")
    return df.join(keys, list(pairs), "left_semi")


def same_key(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Equality of two keys in which null equals null; still an equi-join to Spark."""
    return reduce(
        lambda a, b: a & b, (left[ours].eqNullSafe(right[theirs]) for ours, theirs in pairs.items())
    )


def rename(df: DataFrame, names: list[str], new_names: list[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(names, new_names)))
