"""Find benchmark items inside documents: MinHash containment search over size partitions, verified exactly. DataFrame
functions only.

A text is its distinct shingles of five words (runs of letters and digits, lower case). A document contains an item if
it has at least ``PERCENT`` percent of the item's shingles, however long it is.

Items are partitioned by size, in powers of two. The sketch of an item of n shingles holds its k smallest hashes, k
being one more than it may miss: a document that contains the item has at least one of these hashes. The threshold of
a partition is the largest hash in its sketches; the sketch of a document is its hashes up to the largest threshold of
the partitions whose items are small enough to be contained in it. So the sketches miss nothing, and hashes above the
thresholds, most of them, are never compared. Pairs whose sketches meet are verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reqmart.session import materialise

PERCENT = 80
SHINGLE = 5


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def runs_of(words: Column, length: int, of) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - length + 1, F.lit(1)))
    return F.transform(places, lambda i: of(F.slice(words, i, length)))


def shingles(words: Column, of, shorter: list[int] = []) -> Column:
    """``of`` each run of five words; a shorter text is one run, an empty one has none. Runs of the ``shorter`` lengths
    come besides.
    """
    none = F.array().cast(runs_type(of))
    runs = F.when(F.size(words) > 0, runs_of(words, SHINGLE, of)).otherwise(none)
    others = [F.when(F.size(words) >= n, runs_of(words, n, of)).otherwise(none) for n in shorter]
    return F.concat(runs, *others) if others else runs


def runs_type(of) -> str:
    return "array<string>" if of is as_text else "array<bigint>"


def as_text(run: Column) -> Column:
    return F.array_join(run, " ")


def as_hash(run: Column) -> Column:
    return F.xxhash64(run)


def least_shared(size: Column, percent: int) -> Column:
    return F.ceil(size * percent / 100).cast("int")


def item_sketches(items: DataFrame, percent: int) -> DataFrame:
    """item_id, size, the partition (power of two) and the smallest hashes of each item with words."""
    hashes = items.select("item_id", F.array_sort(F.array_distinct(shingles(F.col("words"), as_hash))).alias("hashes"))
    sized = hashes.withColumn("size", F.size("hashes")).where("size > 0")
    return sized.select(
        "item_id", "size", F.floor(F.log2("size")).cast("int").alias("partition"),
        F.slice("hashes", F.lit(1), F.col("size") - least_shared(F.col("size"), percent) + 1).alias("sketch"),
    )


def threshold(n_words: Column, sketches: DataFrame, percent: int) -> Column:
    """The largest hash worth comparing for a text of so many words: null if it is too small for any item."""
    by_partition = sketches.groupBy("partition").agg(
        F.min(least_shared(F.col("size"), percent)).alias("least"), F.max(F.array_max("sketch")).alias("most")
    )
    chosen, most = F.lit(None).cast("bigint"), None
    room = F.greatest(n_words - SHINGLE + 1, F.lit(1))
    for row in by_partition.orderBy("least", "partition").collect():  # a row per power of two
        most = row["most"] if most is None else max(most, row["most"])
        chosen = F.when(room >= row["least"], F.lit(most)).otherwise(chosen)
    return chosen


def leaks(docs: DataFrame, items: DataFrame, percent: int, least_words: int) -> DataFrame:
    """The pairs of ``contained_items``, with text_hash: doc_id and text_hash name a document, whatever its id."""
    read_items = items.select("item_id", F.xxhash64("text").alias("item_hash"), words(F.col("text")).alias("words"))
    short = read_items.select(F.size("words").alias("n")).where(F.col("n").between(least_words, SHINGLE - 1))
    shorter = sorted(row["n"] for row in short.distinct().collect()) if least_words < SHINGLE else []  # four at most
    item = ["item_id", "item_hash"]
    runs = read_items.select(*item, F.array_distinct(shingles(F.col("words"), as_text)).alias("runs"))
    whole = materialise(
        runs.select(*item, F.size("runs").cast("bigint").alias("item_size"), F.explode("runs").alias("shingle")).distinct()
    )
    sketches = materialise(item_sketches(read_items, percent))
    sketched = materialise(sketches.select("item_id", F.explode("sketch").alias("hash")).distinct())

    document = ["doc_id", "text_hash"]
    read_docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    worth = threshold(F.size("words"), sketches, percent)
    hashes = read_docs.withColumn("worth", worth).where("worth IS NOT NULL").select(
        *document, "worth", F.explode(shingles(F.col("words"), as_hash, shorter)).alias("hash")
    )
    meeting = hashes.where("hash <= worth").join(sketched, "hash").select(*document, "item_id").distinct()
    candidates = materialise(meeting)

    # Only documents of some candidate are read as text again.
    wanted = candidates.select(*document).distinct()
    same = read_docs.doc_id.eqNullSafe(wanted.doc_id) & (read_docs.text_hash == wanted.text_hash)
    looked_at = read_docs.join(wanted, same, "left_semi")
    own = looked_at.select(*document, F.explode(F.array_distinct(shingles(F.col("words"), as_text, shorter))).alias("shingle"))
    pair = [*document, *item, "item_size"]
    hits = own.join(whole, "shingle").select(*pair, "shingle").distinct()
    counted = hits.groupBy(*pair).agg(F.count("*").alias("shared"))
    return counted.where(F.col("shared") * 100 >= F.col("item_size") * percent)


def contained_items(
    docs: DataFrame, items: DataFrame, percent: int = PERCENT, least_words: int = SHINGLE
) -> DataFrame:
    """The pairs of a document and an item it contains: doc_id, item_id, item_size, shared, containment.

    ``docs`` has doc_id and text, ``items`` item_id and text; no other column is read. Null and empty texts contain
    nothing and are contained in nothing. An item of fewer than five words is one run; from ``least_words`` on it is
    found within longer texts, below only in texts of the same words, since a word or two are in any text. Other columns
    may have any names; texts of any length are read whole. Rows with the same id and text count as one document or item; other texts of an id are documents or items of their
    own, each with its pairs, and so are the texts of null ids. Empty tables give no pairs.
    """
    return leaks(docs, items, percent, least_words).select(
        "doc_id", "item_id", "item_size", "shared", (F.col("shared") / F.col("item_size")).alias("containment")
    )


def decontaminated(
    docs: DataFrame, items: DataFrame, percent: int = PERCENT, least_words: int = SHINGLE
) -> DataFrame:
    """The documents that contain no item, with all their columns. Other texts of the same id, or without one, stay."""
    found = leaks(docs, items, percent, least_words).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")
    ).distinct()
    same = docs.doc_id.eqNullSafe(found.found_id) & (F.xxhash64(docs.text) == found.found_hash)
    return docs.join(found, same, "left_anti")
