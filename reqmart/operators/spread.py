"""Keeping joins to grouped tables splittable."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(grouped: DataFrame) -> DataFrame:
    """Spread the rows of a grouped lookup anew, so that a join to it brings a shuffle of its own.

    Adaptive execution splits a hot key only where both sides of the join come straight from a
    shuffle. A side grouped by the join key would lend the join its partitioning instead, and all
    facts of a hot key would stay in one task. The price is one more shuffle of the lookup, not of
    the facts; where the lookup is small enough to be broadcast, it is next to nothing.
    """
    return grouped.hint("rebalance")
