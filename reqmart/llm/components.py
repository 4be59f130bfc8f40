"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reqmart.session import materialise

#: Links that a task ties into stars. Bounds its memory only.
TIED_AT_ONCE = 200_000


def forest(pairs: Iterator[tuple]) -> list[tuple]:
    """(node, smallest node connected with it) for the nodes of the pairs, but the smallest themselves."""
    above: dict = {}

    def root(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = above[x]
        return x

    for u, v in pairs:
        a, b = root(u), root(v)
        if a != b:
            above[max(a, b)] = min(a, b)
    return [(x, r) for x in list(above) if (r := root(x)) != x]


def tied_in_tasks(links: DataFrame) -> DataFrame:
    """Links (u, v) that connect the same nodes: each task replaces what it has by stars, which spares rounds."""

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        found = forest((u, v) for batch in held for u, v in zip(*(batch.column(k).to_pylist() for k in (0, 1))))
        if found:
            columns = [pa.array([pair[k] for pair in found], held[0].schema.types[k]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    tasks = max(1, math.ceil(links.count() / TIED_AT_ONCE))
    return links.repartition(tasks).mapInArrow(tie, links.schema)


def are_stars(links: DataFrame) -> bool:
    """Whether each node is tied to one node only, which is tied to none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("centre")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("centre").alias("centre"))
    return nodes.where((F.col("tied") > 1) | ((F.col("tied") > 0) & (F.col("centre") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of the links (u, v): the component is its smallest node.

    Tasks tie the links they have into stars first, which is all for a small graph. Each round then ties every node to
    the smallest neighbour, first for its larger and then for its smaller neighbours; the links become stars in a number
    of rounds that grows with the logarithm of the longest chain. Neighbours are never gathered: a round is two grouped
    minima joined back to the links, written to the shared folder. Links of a node with itself say nothing; null ends
    are not allowed.
    """
    links = materialise(links.where("u <> v").select("u", "v"))
    links = materialise(tied_in_tasks(links).distinct())
    while not are_stars(links):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        least = F.col("m").alias("v")
        tied = large.join(smallest, "u").select(
            F.explode(F.array(F.struct("u", least), F.struct(F.col("v").alias("u"), least)))
        )
        links = materialise(tied.select("col.*").where("u <> v").distinct())
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
