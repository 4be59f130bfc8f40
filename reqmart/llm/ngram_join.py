"""Jaccard join of shingle sets by T-occurrence search.

Two sets of n and m shingles are similar enough if they share T = ceil(p (n + m) / (100 + p)) of them, p being the
similarity in percent. So a set looks for the sets that occur at least T times in the inverted lists of its shingles.
DivideSkip does that: of a set's lists the longest are set aside; the short ones are merged by a heap, which skips
whatever cannot reach T less the number of long lists any more; what it finds is looked up in the long lists by binary
search until it reaches its own T or cannot.

Spark brings together the sets that such a search has to see:

1. Equal sets are one node. Of each node a sample is taken, its smallest hashes, half as many more as it may miss. If
   more of them occur in no other node's sample than the node may miss, it is linked with nothing. Most documents go
   here, at the cost of a quarter of their shingles. The rest is counted once more without those that went.
2. The remaining nodes' whole sets are counted. A node's rarest shingles, one more than it may miss, are its key
   shingles; linked nodes share one. Components of shared key shingles are families; a link never leaves its family.
3. Each family is searched. One that is larger than ``FAMILY_SHINGLES`` is cut by size of set and by hash into parts,
   and every two parts whose sizes may match are searched together.

A search returns one link for each two nodes that it finds to be connected, not every pair that is similar, so a group
of copies gives as many links as it has members. Nothing is approximate: the sets are those of 64-bit hashes of shingles.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reqmart.llm.components import components
from reqmart.llm.text_bytes import mix, numbers, shingle_sets
from reqmart.operators.spread import spread
from reqmart.session import FILTER_BEFORE_JOIN, materialise, settings

WORDS = 4
PERCENT = 85
#: Shingles of a family, or of a part of one, that a task searches at once. Bounds its time and memory only.
FAMILY_SHINGLES = 250_000
#: Rounds in which nodes that meet too few others are left out, by their samples.
ROUNDS = 2
#: Texts hashed at a time.
TEXTS = 100
#: How much a long list costs to look up, against one that is merged (DivideSkip's constant).
MU = 0.0085

DIGESTS = "doc_id long, row long, n_shingles long, node binary, sample array<long>"
SETS = "node binary, shingles array<long>"
LINKS = "u binary, v binary"


def shared_least(n: int, m: int, percent: int) -> int:
    """Shingles that sets of n and m must share."""
    return -(-percent * (n + m) // (100 + percent))


def may_miss(n: Column | int, percent: int) -> Column | int:
    """Shingles that a set of n may lack in a set it is linked with, which has percent % of n at least."""
    return n - F.ceil(n * percent / F.lit(100)) if isinstance(n, Column) else n - -(-n * percent // 100)


def sample_size(n: int, percent: int) -> int:
    return 3 * may_miss(n, percent) // 2 + 1


def node_name(shingles: np.ndarray) -> bytes:
    """Two hashes of the set."""
    return b"".join(int(mix(shingles * x).sum(dtype=np.uint64)).to_bytes(8, "big") for x in numbers(2, 43))


def row_key(docs: DataFrame) -> Column:
    """Hash of a row's id and text: names the row also where ids are null or repeat."""
    return F.xxhash64(docs.doc_id.cast("bigint"), docs.text)


def digests(docs: DataFrame, percent: int) -> DataFrame:
    """A row per document: doc_id, row (its key), n_shingles, and for a set that isn't empty node and sample."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                sets = shingle_sets(part.column(1).to_pylist(), WORDS)
                samples = [s[: sample_size(len(s), percent)].view(np.int64) if len(s) else None for s in sets]
                columns = [
                    part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_name(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(samples, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n_shingles", "node", "sample"])

    texts = docs.select(F.col("doc_id").cast("bigint"), "text", row_key(docs).alias("row"))
    return texts.mapInArrow(compute, DIGESTS)


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full sets of nodes (node, row), from the texts of these rows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                sets = shingle_sets(part.column(1).to_pylist(), WORDS)
                wanted = part.column(0).to_pylist()
                # Another row may have the same key by chance; only the text with this set counts.
                own = [(n, s.view(np.int64)) for n, s in zip(wanted, sets) if node_name(s) == n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in own], pa.binary()), pa.array([s for _, s in own], pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    texts = docs.select(row_key(docs).alias("row"), "text").join(nodes, "row")
    return texts.select("node", "text").mapInArrow(compute, SETS).dropDuplicates(["node"])


def met(postings: DataFrame) -> DataFrame:
    """Those of the postings (a node, shingle) whose shingle others have too, with df, how many do."""
    frequencies = postings.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    return postings.join(spread(frequencies), "shingle")


def few_alone(looked_at: Column, opened: Column, percent: int) -> Column:
    """Whether few enough of the shingles looked at are in no other node, for a link to be possible."""
    return looked_at - opened <= may_miss(F.col("n"), percent)


def families(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, family) of the nodes (node, n, open) that share a key shingle with another."""
    # Those that are in no other set come first among the rarest: they count as missed.
    missed = F.col("n") - F.size("open")
    keys = F.slice("open", F.lit(1), (may_miss(F.col("n"), percent) - missed + 1).cast("int"))
    keyed = materialise(nodes.select("node", F.explode(keys["shingle"]).alias("shingle")))
    first = keyed.groupBy("shingle").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    shared = spread(first.where("first <> last").select("shingle", "first"))
    stars = keyed.join(shared, "shingle").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    return components(stars).withColumnRenamed("component", "family")


def dealt(sets: DataFrame, percent: int) -> DataFrame:
    """The rows of sets (node, shingles, family, any others) with the searches each goes into: columns search, side.

    A family within bounds is one search (null). A larger one is cut by size into bands, so that linked sets are in one
    band or in neighbouring ones, and each band by hash into parts. A search takes one part, or two, of which it only
    compares sets of different sides.
    """
    n = F.size("shingles")
    band = F.floor(F.log(n.cast("double")) / -math.log(percent / 100 - 1e-9)).cast("int")
    sized = sets.withColumn("band", band)
    totals = materialise(sized.groupBy("family", "band").agg(F.sum(n).alias("n")))
    large = totals.groupBy("family").agg(F.sum("n").alias("n")).where(F.col("n") > FAMILY_SHINGLES).select("family")
    parts = totals.join(large, "family").select("family", "band", F.ceil(F.col("n") / FAMILY_SHINGLES).alias("parts"))
    others = parts.select(
        "family", F.col("band").alias("other_band"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    placed = sized.join(spread(parts), ["family", "band"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    met = placed.withColumn("other_band", F.explode(F.array(*(F.col("band") + by for by in (-1, 0, 1)))))
    met = met.join(spread(others), ["family", "other_band"])
    is_first = F.struct("band", "part") <= F.struct(F.col("other_band").alias("band"), F.col("other").alias("part"))
    here, there = F.concat_ws(".", "band", "part"), F.concat_ws(".", "other_band", "other")
    search = F.when(is_first, F.concat_ws(":", here, there)).otherwise(F.concat_ws(":", there, here))
    side = F.when(here != there, is_first.cast("int"))
    cut = met.select(*sets.columns, search.alias("search"), side.alias("side"))
    nothing = F.lit(None)
    whole = sets.join(spread(large), "family", "left_anti").select(
        *sets.columns, nothing.cast("string").alias("search"), nothing.cast("int").alias("side")
    )
    return whole.union(cut)


class Lists:
    """Inverted lists of sets that are in ascending order of size; entries are places of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        _, of, lengths = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(of, kind="stable")
        self.entries = owner[order]
        self.place = np.empty(len(of), dtype=np.int64)  # of each set's own entries
        self.place[order] = np.arange(len(of))
        self.list_ends = np.cumsum(lengths)[of]

    def later(self, x: int, upto: int) -> list[np.ndarray]:
        """The entries after ``x`` and before ``upto`` in the lists of the set ``x``, where there are any."""
        mine = slice(self.ends[x] - self.sizes[x], self.ends[x])
        begins, ends = self.place[mine] + 1, self.list_ends[mine]
        some = begins < ends
        some[some] = self.entries[begins[some]] < upto
        lists = [self.entries[b:e] for b, e in zip(begins[some].tolist(), ends[some].tolist())]
        return [found if found[-1] < upto else found[: np.searchsorted(found, upto)] for found in lists]


def merged(lists: list[list[int]], least: int) -> dict[int, int]:
    """Entries that occur in ``least`` or more of the lists, with their counts, by a heap of the lists' heads."""
    heap = [(entries[0], k, 0) for k, entries in enumerate(lists)]
    heapq.heapify(heap)
    found = {}
    while len(heap) >= least:
        head, taken = heap[0][0], []
        while heap and heap[0][0] == head:
            taken.append(heapq.heappop(heap))
        count = len(taken)
        if count >= least:
            found[head] = count
            upto = head + 1
        else:
            # Those taken can make up for the rest only from the next head that enough lists may hold.
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                break
            upto = heap[0][0]
        for _, k, at in taken:
            at = bisect_left(lists[k], upto, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))
    return found


def links_among(sets: list[np.ndarray], sides: list[int | None], percent: int) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets that are linked, directly or by others; a set of one side is compared
    with those of the other side only, where it has one. The sets are in ascending order of size.
    """
    index = Lists(sets)
    side = np.array([-1 if s is None else s for s in sides])
    label = np.arange(len(sets))
    found = []
    for x, n in enumerate(index.sizes.tolist()):
        upto = int(np.searchsorted(index.sizes, n * 100 // percent, side="right"))
        lists = index.later(x, upto)
        least = shared_least(n, n, percent)
        if len(lists) < least:
            continue
        lists.sort(key=len)
        # DivideSkip's rule for how many lists are long; the short ones have to hold an entry at least once.
        n_long = min(least - 1, int(least / (MU * math.log(len(lists[-1]) + 1) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        if least - n_long == 1:
            entries, counts = np.unique(np.concatenate(short), return_counts=True)
        else:
            occurs = merged([entries.tolist() for entries in short], least - n_long)
            entries, counts = np.fromiter(occurs, np.int64, len(occurs)), np.fromiter(occurs.values(), np.int64, len(occurs))
        other = label[entries] != label[x]
        other &= (side[entries] != side[x]) | (side[x] < 0)
        entries, counts = entries[other], counts[other]
        needed = -(-percent * (n + index.sizes[entries]) // (100 + percent))
        for left, entries_of in zip(range(len(long), 0, -1), long):
            hopeful = counts + left >= needed
            if not hopeful.all():
                entries, counts, needed = entries[hopeful], counts[hopeful], needed[hopeful]
            if not len(entries):
                break
            at = np.minimum(np.searchsorted(entries_of, entries), len(entries_of) - 1)
            counts = counts + (entries_of[at] == entries)
        for y in entries[counts >= needed].tolist():
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                found.append((x, y))
    return found


def searched(parts: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect the linked nodes of each search."""

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        values = table.column("shingles").combine_chunks()
        offsets, flat = values.offsets.to_numpy(), values.values.to_numpy()
        sizes = np.diff(offsets)
        nodes, sides = table.column("node").to_pylist(), table.column("side").to_pylist()
        order = sorted(range(len(nodes)), key=lambda i: (sizes[i], nodes[i]))
        sets = [flat[offsets[i] : offsets[i + 1]] for i in order]
        pairs = links_among(sets, [sides[i] for i in order], percent)
        u, v = ([nodes[order[pair[k]]] for pair in pairs] for k in (0, 1))
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    return parts.groupBy("family", "search").applyInArrow(search, LINKS)


def linked(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, its own included) per document.

    ``docs`` has doc_id and text; no other column is read. A document's set holds the hashes of its runs of ``WORDS``
    words, A to Z in lower case; a shorter text is one run. Null, empty and blank texts have an empty set and are linked
    with nothing; their component is their own doc_id. Rows are linked by their texts, whether ids repeat or are null;
    the rows of one id are not linked by it, and a null id never names a component; that of a class that only such rows
    have is null. Ties don't occur, an empty table gives an empty one, and texts of any length are read whole.
    """
    digested = materialise(digests(docs, percent))
    has_words = F.col("node").isNotNull()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    one_each = digested.where(has_words).groupBy("node").agg(
        first["row"].alias("row"), F.max("n_shingles").alias("n"), F.first("sample").alias("sample")
    )
    # A hash of the name serves to count; two nodes of one hash would only be counted as met too often.
    nodes = materialise(one_each.withColumn("name", F.xxhash64("node")))
    wanted = nodes
    for _ in range(ROUNDS):
        opened = met(wanted.select("name", F.explode("sample").alias("shingle"))).groupBy("name").agg(
            F.count("*").alias("opened")
        )
        enough = few_alone(F.size("sample"), F.col("opened"), percent)
        wanted = materialise(wanted.join(opened, "name").where(enough).drop("opened"))
    # Spark filters the texts by a narrow table that is filtered itself; that comparison holds for all.
    rows = materialise(wanted.select("node", "row", "n"))
    with settings(docs.sparkSession, FILTER_BEFORE_JOIN):
        sets = materialise(sets_of(docs, rows.where("n > 0").select("node", "row")))
    found = met(sets.select("node", F.explode("shingles").alias("shingle"))).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("open")
    )
    rarest_first = sets.select("node", F.size("shingles").alias("n")).join(found, "node")
    whole = materialise(rarest_first.where(few_alone(F.col("n"), F.size("open"), percent)))
    members = families(whole, percent)
    links = searched(dealt(sets.join(members, "node"), percent), percent)
    tied = components(links)
    named = digested.select("doc_id", "n_shingles", "node").join(spread(tied), "node", "left")
    labelled = named.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("label"))
    firsts = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    joined = labelled.join(spread(firsts), "label", "left")
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))
