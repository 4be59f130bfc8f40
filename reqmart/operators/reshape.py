"""Rows from lists, columns into rows, conditional sums, and date spines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def explode_list(df: DataFrame, column: str, separator: str = "_") -> DataFrame:
    """One row per element of a delimited text column; a null text gives no row."""
    return df.withColumn(column, F.explode(F.split(F.col(column), re.escape(separator))))


def unpivot_groups(
    df: DataFrame, ids: list[str], label: str, groups: dict[str, list[str]], names: list[str]
) -> DataFrame:
    """One row per group of columns: ``label`` holds the group's name, ``names`` its values."""
    rows = F.array(
        *(
            F.struct(F.lit(key).alias(label), *(F.col(c).alias(n) for c, n in zip(columns, names)))
            for key, columns in groups.items()
        )
    )
    return df.select(*ids, F.inline(rows))


def unpivot_measures(
    df: DataFrame, ids: list[str], measures: list[str], name: str = "col0", value: str = "col1"
) -> DataFrame:
    """One row per measure column: its name and its value."""
    return df.unpivot(ids, measures, name, value)


def conditional_sums(
    df: DataFrame, keys: list[str | Column], value: str, categories: list[str], accepted: list[str]
) -> DataFrame:
    """Per category column, the sum of ``value`` over the rows whose category is an accepted one."""
    sums = (
        F.sum(F.when(F.col(c).isin(accepted), F.col(value)).otherwise(F.lit(0))).alias(c)
        for c in categories
    )
    return df.groupBy(*keys).agg(*sums)


def pick_by_name(name: Column, measures: list[str]) -> Column:
    """The measure whose column is named by ``name``; null if there is none of that name."""
    chosen = F.when(name == measures[0], F.col(measures[0]))
    for measure in measures[1:]:
        chosen = chosen.when(name == measure, F.col(measure))
    return chosen


def date_spine(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """Every day from ``first`` to ``last``, both columns of the one-row relation ``bounds``."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))
