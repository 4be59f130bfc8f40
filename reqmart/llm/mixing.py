"""Mix sources to target weights by systematic sampling. DataFrame functions only.

Within a source every document has the same expected number of copies, target size / source size. The documents of a
source stand in one line, by size; the expected copies are summed along the line, one random offset is added, and a
document is emitted once for each whole number its stretch of the line crosses. As neighbours in the line have nearly
the same size, the words taken come near the target.

No task needs a whole source. The line is cut into blocks (size class, then one of 256 salts taken from the id, or from
the text where there is none), whose counts are summed per source first: a few thousand rows whatever the size of the source. Only the place within its
block is counted over documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reqmart.session import materialise

#: What a word is: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The offset of a source is one of so many steps from 0 to 1: exact in a double for lines of up to 2^36 documents.
OFFSET_STEPS = 65536.0

BLOCK = ["source_key", "no_source", "size_bits", "size_head", "salt"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_copies: int = 3) -> DataFrame:
    """One row per source with its target, from rows (source_key, no_source, source_size), in one task: sources are
    named by those who gather them, thousands, and don't grow with the documents.

    Sources are put in code point order, the null source last, and take the weights in turn. The sum of all sizes is
    shared by weight, but no source gets more than ``most_copies`` times its size; what is above goes to the others by
    weight. Sources in order of size / weight reach their bound one after the other, so running sums find the share
    per weight at which the rest of the sources stays under theirs.
    """
    in_order = Window.orderBy("no_source", "source_key")
    place = (F.row_number().over(in_order) - 1) % len(weights) + 1
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("bigint"))
    weighted = weighted.withColumn("bound", F.col("source_size") * most_copies)

    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), "no_source", "source_key")
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    ).cast("double")
    weight_left = F.sum("weight").over(by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    shared = weighted.select("*", (left / weight_left).alias("share"))
    fits = F.when(F.col("share") * F.col("weight") <= F.col("bound"), F.col("share"))
    share = F.max(fits).over(everything)  # falls from the first that fits on
    return shared.select(
        "source_key", "no_source", "source_size",
        F.least(F.col("bound").cast("double"), F.coalesce(share, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def with_copies(
    docs: DataFrame,
    keep: list[str] | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    most_copies: int = 3,
    seed: int = 17,
) -> DataFrame:
    """A row per document: the columns ``keep`` (default: all) in the struct ``doc``, size, source_size, target and
    copies.

    ``docs`` has doc_id, text and source; its other columns only travel in ``doc``, so their names can't clash. Null
    or empty texts have size 0; a source of size 0 has target 0 and no copies. A null source is a source of its own.
    Null ids are ordered first, rows of one size and id by a hash of the text; repeated rows each get copies of their
    own. An empty table gives an empty one. Texts of any length are read whole. The same rows give the same copies in
    every run.
    """
    kept = docs.columns if keep is None else keep
    size = word_count(F.col("text"))
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("doc"),
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("source"), F.lit("")).alias("source_key"),
        F.col("source").isNull().alias("no_source"),
        size.alias("size"),
        F.xxhash64("text").alias("tie"),
        F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("named_by"),
    )
    classed = sized.withColumn("size_bits", F.length(F.bin("size"))).withColumn(
        "size_head", F.expr("shiftright(size, greatest(size_bits - 6, 0))")
    )
    salt = F.substring(F.coalesce(F.md5(F.col("id").cast("string")), "named_by"), 1, 2)
    blocked = classed.withColumn("salt", salt).drop("named_by")

    per_block = [F.count("*").alias("block_rows"), F.sum("size").alias("block_size")]
    counts = materialise(blocked.groupBy(*BLOCK).agg(*per_block))
    line = Window.partitionBy("source_key", "no_source").orderBy("size_bits", "size_head", "salt")
    starts = counts.select(
        *BLOCK,
        F.coalesce(
            F.sum("block_rows").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("block_start"),
    )
    totals = counts.groupBy("source_key", "no_source").agg(F.sum("block_size").alias("source_size"))
    targets = source_targets(totals, weights, most_copies).withColumn(
        "step",
        F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)),
    )
    named = F.concat(F.lit(f"{seed}:"), F.col("source_key"), F.when(F.col("no_source"), "/null").otherwise("/"))
    offset = F.conv(F.substring(F.md5(named), 1, 4), 16, 10).cast("double") / OFFSET_STEPS
    blocks = starts.join(targets.withColumn("offset", offset), ["source_key", "no_source"])

    in_block = Window.partitionBy(*BLOCK).orderBy("size", "id", "tie")
    placed = blocked.withColumn("place", F.row_number().over(in_block)).join(blocks, BLOCK)
    reached = F.col("block_start") + F.col("place")
    crossed = F.floor(F.col("offset") + F.col("step") * reached) - F.floor(
        F.col("offset") + F.col("step") * (reached - 1)
    )
    return placed.select("doc", "size", "source_size", "target", crossed.cast("bigint").alias("copies"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    taken = with_copies(docs, **settings).where("copies > 0")
    return taken.select("doc", F.explode(F.expr("array_repeat(0, int(copies))"))).select("doc.*")
