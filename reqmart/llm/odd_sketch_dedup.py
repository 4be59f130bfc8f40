"""Near duplicates by MinHash bands, verified by odd sketches and then on full sets.

A document's set is that of its five-word shingles. Documents with equal sets are one node. Nodes that share a band of
MinHash values are candidates; those whose odd sketches (parity bitmaps of one-permutation MinHash samples) differ in
few enough bits are compared on their full sets. Components of the confirmed links are the classes.

Groups of near copies don't become all their pairs. First each node is compared with the hubs of its buckets, the
nodes that share most bands with others, and linked with the one most like it if that is confirmed; the components of
these links are taken. What is still apart within a bucket is searched in tasks: buckets that share nodes make a family,
whose bands, sketches and full sets a task compares (large families in parts, two at a time). A task returns one link for
each two nodes that it finds to be connected, so neither copies nor near copies that stay apart become rows of pairs.

Similarity, 0.85 here, is a share of whole numbers and confirmed exactly. The bands miss a pair of that similarity
with a probability under 1e-5, and the sketches, which allow for about five standard deviations, under 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reqmart.llm.components import components
from reqmart.llm.ngram_join import dealt
from reqmart.llm.text_bytes import mix, numbers, shingle_sets
from reqmart.operators.spread import spread
from reqmart.session import FILTER_BEFORE_JOIN, materialise, settings

BANDS = 24
ROWS = 5
#: Samples (bins of the hash range, the smallest hash of each) behind a sketch, and bits of a sketch.
SAMPLES = 4096
SKETCH_BITS = 2048
#: Texts hashed at a time.
TEXTS = 100

DIGESTS = "doc_id long, row long, n_shingles long, node binary, bands array<long>, sketch array<long>"
SETS = "node binary, shingles array<long>"


def digest(shingles: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Name of the set, hashes of its bands, odd sketch."""
    a, b = numbers(2, 41)
    sums = [int(mix(shingles * x).sum(dtype=np.uint64)) for x in (a, b)]
    node = b"".join(s.to_bytes(8, "big") for s in sums)

    factors = numbers(BANDS * ROWS, 5)
    smallest = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * factors[None, :]
        np.minimum(smallest, part.min(axis=0), out=smallest)
    bands = mix((smallest.reshape(BANDS, ROWS) * numbers(ROWS, 61)).sum(axis=1, dtype=np.uint64))
    bands = mix(bands + numbers(BANDS, 71))

    bins = (shingles >> np.uint64(52)).astype(np.int64)  # 12 bits: SAMPLES bins; shingles are sorted
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    bits = (mix(shingles[first]) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = np.bincount(bits, minlength=SKETCH_BITS) & 1
    sketch = np.packbits(parity.astype(np.uint8), bitorder="little").view("<u8")
    return node, bands.view(np.int64), sketch.view(np.int64)


def row_key(docs: DataFrame) -> Column:
    """Hash of a row's id and text: names the row also where ids are null or repeat."""
    return F.xxhash64(docs.doc_id.cast("bigint"), docs.text)


def digests(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, row (its key), n_shingles, and for a set that isn't empty node, bands, sketch."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows = []
                ids, keys = part.column(0).to_pylist(), part.column(2).to_pylist()
                for doc_id, key, shingles in zip(ids, keys, shingle_sets(part.column(1).to_pylist())):
                    found = digest(shingles) if len(shingles) else (None, None, None)
                    rows.append((doc_id, key, len(shingles), *found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), DIGEST_TYPES)], names=DIGEST_NAMES
                )

    texts = docs.select(F.col("doc_id").cast("bigint"), "text", row_key(docs).alias("row"))
    return texts.mapInArrow(compute, DIGESTS)


DIGEST_NAMES = ["doc_id", "row", "n_shingles", "node", "bands", "sketch"]
DIGEST_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full sets of nodes (node, row), from the texts of these rows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                sets = shingle_sets(part.column(1).to_pylist())
                wanted = part.column(0).to_pylist()
                # Another row may have the same key by chance; only the text with this set counts.
                own = [(n, s.view(np.int64)) for n, s in zip(wanted, sets) if digest_name(s) == n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in own], pa.binary()), pa.array([s for _, s in own], pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    texts = docs.select(row_key(docs).alias("row"), "text").join(nodes, "row")
    return texts.select("node", "text").mapInArrow(compute, SETS).dropDuplicates(["node"])


def full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets of the wanted ones of the nodes (node, row, n_shingles), stored."""
    rows = materialise(nodes.join(wanted, "node"))
    # That comparison holds for all; Spark filters the texts by a side that has one.
    with settings(docs.sparkSession, FILTER_BEFORE_JOIN):
        return materialise(sets_of(docs, rows.where("n_shingles > 0").select("node", "row")))


def digest_name(shingles: np.ndarray) -> bytes:
    a, b = numbers(2, 41)
    return b"".join(int(mix(shingles * x).sum(dtype=np.uint64)).to_bytes(8, "big") for x in (a, b))


def differing() -> Column:
    """Bits in which the sketches of the sides ``a`` and ``b`` differ."""
    return sum(F.bit_count(F.col("a.sketch")[i].bitwiseXOR(F.col("b.sketch")[i])) for i in range(SKETCH_BITS // 64))


def bits_allowed(n_a, n_b, percent: int, exp, sqrt):
    """Bits in which the sketches of sets of these sizes may differ if the sets are that similar.

    Of k bins the union of the sets hits some, and in a share of 1 - s of these its smallest hash is in one set only;
    then the samples differ in that hash and in the other set's, if it has one in the bin. The more bins are hit
    twice, the more that count varies. Of B bits, d differing samples leave about B/2 * (1 - exp(-2d / B)) set, give
    or take d * sqrt(2 / B). Five deviations of either are allowed.
    """
    s, total = percent / 100, n_a + n_b
    union = total / (1 + s)
    hit = SAMPLES * (1 - exp(-union / SAMPLES))
    each = 2 - exp(-total / (2.0 * SAMPLES))
    most = each * (hit * (1 - s) + 5 * sqrt(hit * s * (1 - s) * (1 - hit / union)))
    return SKETCH_BITS / 2 * (1 - exp(-2 * most / SKETCH_BITS)) + 5 * most * (2 / SKETCH_BITS) ** 0.5 + 2


def may_be_similar(percent: int) -> Column:
    """Whether sizes and sketches of the sides ``a`` and ``b`` leave room for that similarity."""
    n_a, n_b = F.col("a.n_shingles"), F.col("b.n_shingles")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    return sizes & (differing() <= bits_allowed(n_a, n_b, percent, F.exp, F.sqrt))


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose full sets are similar enough."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = full_sets(docs, nodes, ends)
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v"
    )
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(shared * 100 >= (F.size("a") + F.size("b") - shared) * percent).select("u", "v")


def links_among(
    components: list, sides: list[int | None], bands: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Pairs of places that connect all nodes that share a band and are similar enough, but for those of one component
    already. The sets are in ascending order of size; a set of one side meets those of the other only, if it has one.
    """
    _, label = np.unique(np.array(components, dtype=object), return_inverse=True)
    side = np.array([-1 if s is None else s for s in sides])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    found = []
    for x, n in enumerate(sizes.tolist()):
        upto = int(np.searchsorted(sizes, n * 100 // percent, side="right"))
        others = np.arange(x + 1, upto)
        others = others[(label[others] != label[x]) & ((side[others] != side[x]) | (side[x] < 0))]
        others = others[(bands[others] == bands[x]).any(axis=1)]
        differ = np.bitwise_count(sketches[others] ^ sketches[x]).sum(axis=1, dtype=np.int64)
        for y in others[differ <= bits_allowed(n, sizes[others], percent, np.exp, np.sqrt)].tolist():
            if label[x] != label[y]:
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if shared * 100 >= (n + len(sets[y]) - shared) * percent:
                    label[label == label[y]] = label[x]
                    found.append((x, y))
    return found


def searched(parts: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect the nodes of each search that are similar enough and were not connected before."""

    def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        values = column.combine_chunks()
        return values.offsets.to_numpy(), values.values.to_numpy()

    def search(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_pylist()
        offsets, flat = lists(table.column("shingles"))
        sizes = np.diff(offsets)
        order = sorted(range(len(nodes)), key=lambda i: (sizes[i], nodes[i]))
        bands = lists(table.column("bands"))[1].reshape(-1, BANDS)[order]
        sketches = lists(table.column("sketch"))[1].view(np.uint64).reshape(-1, SKETCH_BITS // 64)[order]
        known, sides = table.column("component").to_pylist(), table.column("side").to_pylist()
        sets = [flat[offsets[i] : offsets[i + 1]] for i in order]
        pairs = links_among([known[i] for i in order], [sides[i] for i in order], bands, sketches, sets, percent)
        u, v = ([nodes[order[pair[k]]] for pair in pairs] for k in (0, 1))
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    return parts.groupBy("family", "search").applyInArrow(search, "u binary, v binary")


def smallest_row() -> Column:
    """The row of the smallest id, null being the largest, and of its texts the one with the smallest key."""
    return F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))


def classes(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The columns of ``near_duplicates`` with row (the key of id and text), kept and stays.

    ``kept`` says whether the row has its component's id, and is null without one. ``stays`` is true for one row of each
    class: that of the smallest id, or of the smallest text hash if no row of the class has an id or if several have
    that id. Rows that are equal in id and text are one and marked alike. All texts without words stay.
    """
    digested = materialise(digests(docs))
    nodes = materialise(
        digested.where("node IS NOT NULL")
        .groupBy("node")
        .agg(smallest_row()["row"].alias("row"), F.max("n_shingles").alias("n_shingles"))
    )
    # One row per node brings its bands and sketch; equal rows may repeat.
    one_each = digested.where("node IS NOT NULL").select("node", "row", "n_shingles", "bands", "sketch")
    chosen = materialise(one_each.join(nodes.select("node", "row"), ["node", "row"]).dropDuplicates(["node"]))
    bands = chosen.select("node", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialise(bands.join(shared, "bucket"))

    sketches = chosen.select("node", "n_shingles", "sketch")
    met = buckets.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = buckets.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node"))["node"].alias("hub"))
    star = buckets.join(hubs, "bucket").where("node <> hub").select("node", "hub").distinct()
    near = (
        star.join(sketches.alias("b"), "node")
        .join(sketches.withColumnRenamed("node", "hub").alias("a"), "hub")
        .where(may_be_similar(percent))
        .select("node", "hub", (differing() / (F.col("a.n_shingles") + F.col("b.n_shingles"))).alias("unlike"))
    )
    best = near.groupBy("node").agg(F.min(F.struct("unlike", "hub"))["hub"].alias("hub"))
    first = materialise(best.select(F.col("node").alias("u"), F.col("hub").alias("v")))
    tied = materialise(components(confirmed(docs, nodes, first, percent)))

    placed = buckets.join(spread(tied), "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    apart = materialise(placed.join(spread(several.select("bucket")), "bucket"))
    leads = apart.groupBy("bucket").agg(F.min("node").alias("lead"))
    stars = apart.join(spread(leads), "bucket").where("node <> lead")
    families = components(stars.select(F.col("node").alias("u"), F.col("lead").alias("v")))
    members = materialise(
        families.withColumnRenamed("component", "family").join(apart.select("node", "component").distinct(), "node")
    )
    sets = full_sets(docs, nodes, members.select("node"))
    whole = materialise(sets.join(members, "node").join(chosen.select("node", "bands", "sketch"), "node"))
    more = searched(dealt(whole, percent), percent)

    tied = components(tied.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    labelled = digested.select("doc_id", "row", "n_shingles", "node").join(spread(tied), "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("component", "node")).drop("component", "node")
    firsts = labelled.where("label IS NOT NULL").groupBy("label").agg(smallest_row().alias("first"))
    wordless = F.col("label").isNull()
    named = labelled.join(spread(firsts), "label", "left").select(
        "doc_id", "n_shingles", F.when(wordless, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        "row", (wordless | (F.col("row") == F.col("first.row"))).alias("stays"),
    )
    return named.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id linked, itself included) per document.

    ``docs`` has doc_id and text; no other column is read. Null, empty and blank texts have an empty set and are
    linked with nothing. Texts are linked whether their rows have an id or not; the rows of one id are not linked by
    it. A row without an id never names a component; that of a class that only such rows have is null. Repeated rows
    each come back, alike; an empty table gives an empty one; texts of any length are read whole.
    """
    return classes(docs, percent).select("doc_id", "n_shingles", "component_id")


def deduplicated(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each class, with all its columns: the one that ``classes`` lets stay; of rows equal in id and
    text, one. Texts without words stay, once per id.
    """
    rows = materialise(classes(docs, percent).where("stays").groupBy("row").agg(F.count("*").alias("rows")))

    def of(kept: DataFrame) -> DataFrame:
        return docs.join(kept, row_key(docs) == kept.row, "left_semi")

    alone = F.col("rows") == 1
    return of(rows.where(alone)).union(of(rows.where(~alone)).dropDuplicates(["doc_id", "text"]))
