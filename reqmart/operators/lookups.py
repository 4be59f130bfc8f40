"""Lookup tables made safe to join: one row per key, or unambiguous keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqmart.operators.keys import same_key
from reqmart.operators.spread import spread


def distinct_lookup(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns without repeated rows. A key with two values keeps both."""
    return spread(df.select(*columns).distinct())


def one_per_key(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key: the smallest by ``values``, null first, so the choice does not depend on row order.

    A join to it never multiplies the facts. A single value of fixed width is picked by a hash aggregate. Texts and
    several values need one that sorts; repeated rows are hashed together before.
    """
    kinds = dict(df.dtypes)
    if len(values) == 1 and has_fixed_width(kinds[values[0]]):
        value = F.col(values[0])
        smallest = F.when(F.count_if(value.isNull()) == 0, F.min(value))
        return spread(df.groupBy(*keys).agg(smallest.alias(values[0])))
    best = F.min(F.struct(*values)).alias("best")
    picked = df.select(*keys, *values).distinct().groupBy(*keys).agg(best)
    return spread(picked.select(*keys, *(F.col(f"best.{v}").alias(v) for v in values)))


def has_fixed_width(kind: str) -> bool:
    """Whether values of a type fit into the buffers of a hash aggregate."""
    fixed = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
    return kind in fixed or kind.startswith("decimal")


def unique_lookup(df: DataFrame, keys: list[str], values: list[str], by: str = "key") -> DataFrame:
    """Only unambiguous entries of a lookup.

    ``by='key'``: keys that occur in exactly one row, so a join cannot multiply the facts.
    ``by='entry'``: (key, values) pairs that occur in exactly one row; a key with two different
    values appears twice.

    Rows are counted per entry and the entries' counts per key, both by hash aggregates; a key with
    many rows shrinks to its entries before it is shuffled by key. Null keys are one key.
    """
    if by not in ("key", "entry"):
        raise ValueError(f"by must be 'key' or 'entry', not {by!r}")
    entries = df.groupBy(*keys, *values).agg(F.count("*").alias("occurrences"))
    single = entries.where("occurrences = 1").select(*keys, *values)
    if by == "entry":
        return single  # grouped by more than the keys of a join
    once = entries.groupBy(*keys).agg(F.sum("occurrences").alias("occurrences")).where("occurrences = 1")
    once = once.select(*(F.col(k).alias(f"single_{k}") for k in keys))
    return spread(single.join(once, same_key(single, once, {k: f"single_{k}" for k in keys}), "left_semi"))
