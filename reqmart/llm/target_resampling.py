"""Importance resampling: draw the documents that are most like a target by hashed n-grams.

Every n-gram of a text falls into one of ``BUCKETS`` buckets. A bucket's gain is the logarithm of its share in the
target's texts over that in the documents, both counted over all texts. A document's weight is the mean gain of its
n-grams; Gumbel noise, drawn from its id, is added, and the highest scores are drawn: a sample without replacement in
which documents count by their weight.

Counting and weighing go through a table that numbers the n-grams of a batch: open addressing with xxhash64 keys, in
numpy, all occurrences at a time. Equal keys are told apart by the n-grams' bytes. A slot holds the bucket, computed once
per distinct n-gram, and the count; weighing gathers the gains by the slots of the occurrences.

Ranks come from a sort into ranges: only the number of rows of each range is summed over all, so no task sees more than
its range, and rows that are equal in everything are split between ranges as well.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reqmart.llm.text_bytes import LOWER
from reqmart.session import materialise

BUCKETS = 10_000
SEED = 2024
#: A document has to have so many words to be drawn, and so many percent of those that have are.
LEAST_WORDS = 20
PERCENT = 10
#: Bytes of text that share a table; bounds memory only.
TABLE_BYTES = 1 << 20

#: ASCII digits and letters and all other characters make words. Texts are in lower case by then.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Interned:
    """An open-addressed table of the distinct n-grams among ``grams``, and the slot of each occurrence."""

    def __init__(self, grams: list[bytes]):
        n = len(grams)
        keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=n)
        texts = np.empty(n, dtype=object)
        texts[:] = grams
        mask = (1 << max(4, (2 * n).bit_length())) - 1
        self.slots = (keys & np.uint64(mask)).astype(np.int64)
        owner = np.full(mask + 1, -1, dtype=np.int64)  # the occurrence whose key and bytes a slot stands for
        waiting = np.arange(n)
        while len(waiting):
            at = self.slots[waiting]
            free = owner[at] < 0
            owner[at[free]] = waiting[free]  # of those that meet in a free slot one takes it
            held = owner[at]
            placed = keys[held] == keys[waiting]
            placed[placed] = texts[held[placed]] == texts[waiting[placed]]
            waiting = waiting[~placed]
            self.slots[waiting] = (self.slots[waiting] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        self.buckets = np.zeros(mask + 1, dtype=np.int64)
        self.buckets[used] = [zlib.crc32(gram) % BUCKETS for gram in texts[owner[used]]]
        self.counts = np.bincount(self.slots, minlength=mask + 1)

    def bucket_counts(self) -> np.ndarray:
        """Occurrences per bucket."""
        used = np.flatnonzero(self.counts)
        out = np.zeros(BUCKETS, dtype=np.int64)
        np.add.at(out, self.buckets[used], self.counts[used])
        return out

    def gathered(self, gains: np.ndarray) -> np.ndarray:
        """The gain of each occurrence's bucket."""
        return gains[self.buckets][self.slots]


def features(text: str | None, most_words: int) -> tuple[list[bytes], int]:
    """All runs of 1 to ``most_words`` consecutive words, joined by a blank, with repeats; the number of words."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    longer = (b" ".join(words[i : i + n]) for n in range(2, most_words + 1) for i in range(len(words) - n + 1))
    return [*words, *longer], len(words)


def tables(texts: pa.Array, most_words: int) -> Iterator[tuple[int, np.ndarray, Interned]]:
    """Tables over successive texts: place of the first text, features and words of each text, table."""
    at = 0
    while at < len(texts):
        grams, counts, size, upto = [], [], 0, at
        while upto < len(texts) and size < TABLE_BYTES:
            text = texts[upto].as_py()
            own, n_words = features(text, most_words)
            grams += own
            counts.append((len(own), n_words))
            size, upto = size + len(text or "") + 1, upto + 1
        yield at, np.array(counts, dtype=np.int64).T, Interned(grams)
        at = upto


def bucket_counts(docs: DataFrame, most_words: int = 1) -> np.ndarray:
    """Occurrences of features per bucket over all texts. The driver gets a number per bucket, whatever the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, table in tables(batch.column(0), most_words):
                total += table.bucket_counts()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, one added to each."""
    s_all, t_all = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    ratios = (((t + 1) * s_all) / ((s + 1) * t_all) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, most_words: int = 1) -> DataFrame:
    """doc_id, n_features, n_words and weight (the floored mean gain) per document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts, table in tables(batch.column(1), most_words):
                n, n_words = counts
                sums = np.concatenate([[0], np.cumsum(table.gathered(gains))])[np.concatenate([[0], np.cumsum(n)])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at : at + len(n)], pa.array(n), pa.array(n_words),
                        pa.array(np.diff(sums) // np.maximum(n, 1)),
                    ],
                    names=["doc_id", "n_features", "n_words", "weight"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        weigh, "doc_id long, n_features long, n_words long, weight long"
    )


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(share)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with rank, their place from 1 on in that order; rows that are equal in it come in any order."""
    at = F.monotonically_increasing_id()
    # The place in the stored rows splits a range that is full of equal rows.
    dealt = rows.withColumn("at", at).repartitionByRange(*order, "at").sortWithinPartitions(*order, "at")
    # That id has the partition above its 33rd bit and the row's number in it below.
    stored = materialise(dealt.withColumn("at", at))
    placed = stored.withColumns(
        {"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    ).drop("at")
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = (F.col("before") + F.col("place") + 1).alias("rank")
    return placed.join(F.broadcast(offsets), "part").select(*rows.columns, rank)


def resampled(docs: DataFrame, target: DataFrame, most_words: int = 1, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank per document; rank is null for those not drawn.

    ``docs`` has doc_id and text, ``target`` text; no other column is read. Of the documents with ``LEAST_WORDS`` words
    or more, ``percent`` percent are drawn, highest scores first; of equal scores the smaller doc_id, null last, then
    fewer features and the smaller weight. Null, empty and wordless texts have no features and the weight 0. Rows are
    told apart where ids repeat or are null, but rows of one id share its noise. An empty target or empty documents
    count as such: all gains are then those of the added ones. Texts of any length are read whole.
    """
    gains = gains_of(bucket_counts(docs, most_words), bucket_counts(target, most_words))
    scored = materialise(weighed(docs, gains, most_words).withColumn("score", F.col("weight") + noise(F.col("doc_id"))))
    may_be_drawn = F.col("n_words") >= LEAST_WORDS
    draws = scored.where(may_be_drawn).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    places = ranked(scored.where(may_be_drawn), order)
    rank = F.when(F.col("rank") <= draws, F.col("rank")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    undrawn = scored.where(~may_be_drawn).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return places.select(*columns, rank).union(undrawn)
