"""Remove repeated byte strings by refining buckets of sampled suffixes.

A window is a string of ``LENGTH`` bytes of one text. A window that also starts earlier (in a smaller document, or
earlier in the same one) is a repeat, and every byte that a repeat covers is removed.

Windows are sorted into buckets by the smallest hash of the q-grams they hold, at its first place: the anchor. Equal
windows have the same anchor, at the same distance, so they meet in a bucket. Consecutive windows of one anchor make
one row, which is what keeps the sort small: a row per 40 bytes or so in place of a suffix per byte. Within a bucket
rows are sorted by the identity of all their bytes:

- rows of equal bytes: all but the first are repeats,
- the first rows, where bytes differ: some of their windows may still be equal. They are cut into pieces at fixed
  distances from the anchor, whose buckets are named by the bytes that all windows of the piece share, and sorted
  again; then into single windows,
- buckets of one kind of bytes are done.

The rounds work on ever fewer rows. Buckets and bytes are told apart by two 64-bit hashes, of different tables. Each
task sorts out the rows of its own texts first. Of equal rows only the first competes with those of other tasks, and
where a block of text shows that a bucket holds several kinds of bytes, these rows are sorted by their bytes wherever
they are, and the bucket gets one sign of them: so a string that a third of all texts share gathers in one task
neither its copies nor its surroundings. Rows stream by in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reqmart.llm.text_bytes import mix, numbers
from reqmart.session import materialise

LENGTH = 100
GRAM = 24
#: Windows that a round's pieces hold: all of one anchor, then so many, then one.
PIECES = (8, 1)
#: Bytes of text worked on at a time; longer texts are cut, with an overlap.
BLOCK_BYTES = 2_000_000

TABLES = (mix(numbers(256, 101)), mix(numbers(256, 103)))
FACTOR = 0x9E3779B97F4A7C15
#: Stands for a null id: it is the last document.
NO_ID = 2**63 - 1
NULL_TAG = 2**62
#: The place of a row that only tells its bucket of other bytes.
SIGN = -1

ROWS = "slot long, bytes long, open boolean, doc long, tag long, place long"
DONE = "doc long, tag long, place long, slot long"


class Hashes:
    """Hashes of all ranges of a block of bytes, by prefix sums; the powers are shared by all blocks of a task."""

    powers = inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, block: np.ndarray):
        n = len(block) + 1
        if len(Hashes.powers) < n:
            for name, factor in (("powers", FACTOR), ("inverses", pow(FACTOR, -1, 2**64))):
                steps = np.full(n, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(Hashes, name, np.cumprod(steps))
        self.sums = []
        for table in TABLES:
            sums = np.zeros(n, dtype=np.uint64)
            np.cumsum(table[block] * Hashes.powers[: n - 1], out=sums[1:])
            self.sums.append(sums)

    def of(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        return mix((sums[ends] - sums[starts]) * Hashes.inverses[starts] + (ends - starts).astype(np.uint64))


def pack(starts: np.ndarray, counts: np.ndarray, to_anchor: np.ndarray) -> np.ndarray:
    """First window, number of windows and distance from the first window to the anchor, as one number."""
    return starts.astype(np.int64) << 14 | (counts - 1) << 7 | to_anchor


def unpack(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return places >> 14, (places >> 7 & 127) + 1, places & 127


def anchors(hashes: Hashes, n: int) -> np.ndarray:
    """For each window start of a block of n bytes the place of the first smallest q-gram hash in it."""
    places = np.arange(n - GRAM + 1)
    least = hashes.of(0, places, places + GRAM)
    where = places.astype(np.int32)
    span, width = 1, LENGTH - GRAM + 1
    while span < width:
        step = min(span, width - span)
        later = least[step:] < least[:-step]
        where = np.where(later, where[step:], where[:-step])
        least = np.minimum(least[step:], least[:-step])
        span += step
    return where


def segments(docs: list[int], tags: list[int], texts: list[bytes]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Blocks of (doc, tag, offset, bytes); windows that start in one segment end in it."""
    block, size = [], 0
    for doc, tag, text in zip(docs, tags, texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), BLOCK_BYTES):
            part = text[at : at + BLOCK_BYTES + LENGTH - 1]
            if size + len(part) > BLOCK_BYTES and block:
                yield block
                block, size = [], 0
            block.append((doc, tag, at, part))
            size += len(part)
    if block:
        yield block


def anchored_rows(block: list[tuple[int, int, int, bytes]]) -> dict[str, np.ndarray]:
    """A row for each run of windows with one anchor."""
    lengths = np.array([len(b) for *_, b in block])
    whole = np.frombuffer(b"".join(b for *_, b in block), dtype=np.uint8)
    hashes = Hashes(whole)
    where = anchors(hashes, len(whole))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    inside = np.zeros(len(whole) + 1, dtype=np.int8)
    inside[begins] += 1
    inside[ends - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[: len(where)]))
    at = where[starts]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(starts) != 1)]))
    low, anchor = starts[first], at[first]
    count = np.diff(np.append(first, len(starts)))
    owner = np.searchsorted(ends, low, side="right")
    return _rows(
        block, owner, low - begins[owner], count, anchor - low,
        hashes.of(0, anchor, anchor + GRAM), hashes.of(1, low, low + count - 1 + LENGTH),
    )


def _rows(block, owner, start, count, to_anchor, slot, content) -> dict[str, np.ndarray]:
    docs, tags, offsets = (np.array([b[i] for b in block], dtype=np.int64)[owner] for i in range(3))
    places = pack(start + offsets, count, to_anchor)
    return {"slot": slot, "bytes": content, "doc": docs, "tag": tags, "place": places}


def sorted_out(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """What a task can tell from its own rows.

    Repeats get no bytes and no bucket in particular. Rows of a bucket with other bytes are open; their bucket is
    named by their bytes as well, and a sign goes to the old one.
    """
    order = np.lexsort((rows["place"], rows["tag"], rows["doc"], rows["bytes"], rows["slot"]))
    columns = [rows[c][order] for c in ("slot", "bytes", "doc", "tag", "place")]
    slot, content, doc, tag, place = (c[~told_before(columns, None)] for c in columns)
    same_slot = np.concatenate([[False], slot[1:] == slot[:-1]])
    repeat = same_slot & np.concatenate([[False], content[1:] == content[:-1]])
    bucket = np.cumsum(~same_slot) - 1
    several = np.bincount(bucket, ~repeat)[bucket] > 1
    signs = np.flatnonzero(several & ~same_slot)
    still = several & ~repeat
    moved = np.where(repeat, mix(place.astype(np.uint64) + doc.astype(np.uint64)), np.where(still, mix(slot ^ content), slot))
    n = len(signs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([moved, slot[signs]]).view(np.int64)),
            pa.array(np.concatenate([content, content[signs]]).view(np.int64), mask=np.append(repeat, np.zeros(n, dtype=bool))),
            pa.array(np.append(still, np.zeros(n, dtype=bool))),
            pa.array(np.append(doc, np.full(n, -(2**63)))),  # before all documents
            pa.array(np.append(tag, np.full(n, -1))),
            pa.array(np.append(place, np.full(n, SIGN))),
        ],
        names=["slot", "bytes", "open", "doc", "tag", "place"],
    )


def told_before(columns: list[np.ndarray], before: tuple | None) -> np.ndarray:
    """Rows that are equal to the one before them: of documents that are there twice."""
    first = before is not None and len(columns[0]) > 0 and all(c[0] == b for c, b in zip(columns, before))
    rest = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return np.concatenate([[first], rest])[: len(columns[0])]


def initial_buckets(docs: DataFrame) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).fill_null("").to_pylist()]
            for block in segments(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                yield sorted_out(anchored_rows(block))

    return docs.select("doc", "tag", "text").mapInArrow(compute, ROWS)


def cut(docs: DataFrame, pending: DataFrame, size: int) -> DataFrame:
    """Pieces of ``size`` windows of the pending rows, in buckets named by the bytes that their windows share.

    Pieces begin at multiples of ``size`` from the anchor, so that equal windows are in pieces of the same place.
    """
    lists = pending.groupBy("doc", "tag").agg(F.collect_list("place").alias("places"))
    joined = docs.select("doc", "tag", "text").join(lists, ["doc", "tag"])

    def pieces(doc: int, tag: int, text: bytes, places: np.ndarray) -> dict[str, np.ndarray]:
        start, count, to_anchor = unpack(np.unique(places))
        anchor = start + to_anchor
        # Windows by their distance to the anchor, from the last (nearest) to the first.
        nearest = to_anchor - count + 1
        cuts = to_anchor // size - nearest // size + 1
        row = np.repeat(np.arange(len(start)), cuts)
        number = nearest[row] // size + np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        far = np.minimum(number * size + size - 1, to_anchor[row])
        near = np.maximum(number * size, nearest[row])
        low, n = anchor[row] - far, far - near + 1
        # Only the bytes around pending rows are hashed.
        begin, end = start, start + count - 1 + LENGTH
        lengths = end - begin
        shift = begin - (np.cumsum(lengths) - lengths)
        whole = np.frombuffer(text, dtype=np.uint8)
        local = Hashes(whole[np.repeat(shift, lengths) + np.arange(lengths.sum())])
        moved = -shift[row]
        core = anchor[row] - number * size, anchor[row] - number * size - size + 1 + LENGTH
        slot = mix(local.of(0, core[0] + moved, core[1] + moved) + number.astype(np.uint64))
        content = local.of(1, low + moved, low + n - 1 + LENGTH + moved)
        return _rows([(doc, tag, 0, b"")], np.zeros(len(row), dtype=np.int64), low, n, far, slot, content)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                pieces(
                    doc.as_py(), tag.as_py(), text.as_py().encode("utf-8", "surrogatepass"), places.values.to_numpy()
                )
                for doc, tag, text, places in zip(*(batch.column(i) for i in range(4)))
            ]
            if found:
                yield sorted_out({c: np.concatenate([f[c] for f in found]) for c in found[0]})

    return joined.select("doc", "tag", "text", "places").mapInArrow(compute, ROWS)


def refined(rows: DataFrame) -> DataFrame:
    """The repeats (slot null) and the pending rows (slot given), from all rows of the buckets.

    Rows come sorted by bucket, bytes and place and are sorted out as they stream by: in a run of equal bytes all but
    the first are repeats; the first is pending if its bucket holds other bytes.
    """

    def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The row before, and the first row of its bucket while no other bytes are seen in it.
        before, held = None, None
        for batch in batches:
            slot, doc, tag, place = (batch.column(i).to_numpy() for i in (0, 3, 4, 5))
            known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            content = batch.column(1).fill_null(0).to_numpy()
            still = batch.column(2).to_numpy(zero_copy_only=False)
            yield from _judged(doc[known], tag[known], place[known], None)
            slot, content, still, doc, tag, place = (x[~known] for x in (slot, content, still, doc, tag, place))
            new = ~told_before([slot, content, doc, tag, place], before)
            slot, content, still, doc, tag, place = (x[new] for x in (slot, content, still, doc, tag, place))
            if not len(slot):
                continue
            on = before is not None
            same_slot = np.concatenate([[on and before[0] == slot[0]], slot[1:] == slot[:-1]])
            same = same_slot & np.concatenate([[on and before[1] == content[0]], content[1:] == content[:-1]])
            real = place != SIGN
            # A sign stands before the rows of its bytes; the first real one after it is no repeat.
            first_real = real & np.concatenate([[on and before[4] == SIGN], ~real[:-1]]) & same
            repeats = same & real & ~first_real
            yield from _judged(doc[repeats], tag[repeats], place[repeats], None)

            kinds = np.flatnonzero(~same)
            if held is not None and len(kinds) and slot[kinds[0]] == held[3]:
                yield from _judged(*held[:3], np.array([held[3]]))
            if len(kinds):
                held = None
                several = same_slot[kinds] | np.append(slot[kinds[1:]] == slot[kinds[:-1]], False)
                among = np.zeros(len(slot), dtype=bool)
                among[kinds] = several
                among |= first_real  # a sign tells of other bytes
                among |= still & ~repeats
                among &= real
                yield from _judged(doc[among], tag[among], place[among], slot[among])
                end = kinds[-1]
                if not several[-1] and real[end] and not still[end]:
                    held = doc[end : end + 1], tag[end : end + 1], place[end : end + 1], slot[end]
            elif first_real.any():
                yield from _judged(doc[first_real], tag[first_real], place[first_real], slot[first_real])
            before = slot[-1], content[-1], doc[-1], tag[-1], place[-1]

    ordered = rows.repartition("slot").sortWithinPartitions("slot", "bytes", "doc", "tag", "place")
    return ordered.mapInArrow(sort_out, DONE)


def _judged(doc: np.ndarray, tag: np.ndarray, place: np.ndarray, slot: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if len(doc):
        slots = pa.nulls(len(doc), pa.int64()) if slot is None else pa.array(slot)
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(place), slots], names=["doc", "tag", "place", "slot"])


def identified(docs: DataFrame) -> DataFrame:
    """doc (the id), tag (a hash of the text where several rows have that id, else 0; ``NULL_TAG`` more for a null id)
    and text.
    """
    given = F.col("doc_id").cast("bigint")
    ids = docs.select(F.coalesce(given, F.lit(NO_ID)).alias("doc"), given.isNull().alias("no_id"), "text")
    several = materialise(ids.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc", F.lit(1).alias("several")))
    text_hash = F.xxhash64("text").bitwiseAND(F.lit(NULL_TAG - 1))
    tag = F.when(F.col("no_id"), text_hash + NULL_TAG).when(F.col("several").isNull(), F.lit(0)).otherwise(text_hash)
    return ids.join(several, "doc", "left").select("doc", tag.cast("bigint").alias("tag"), "text")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Runs of windows that start earlier too: doc, tag, first window and number of windows."""
    state = materialise(refined(initial_buckets(docs)))
    repeats = state.where("slot IS NULL")
    for size in PIECES:
        state = materialise(refined(cut(docs, state.where("slot IS NOT NULL"), size)))
        repeats = repeats.union(state.where("slot IS NULL"))
    return repeats.select(
        "doc", "tag", F.expr("shiftright(place, 14)").alias("start"), F.expr("(shiftright(place, 7) & 127) + 1").alias("n")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, kept (its remaining bytes), n_bytes, spans (what was removed, as maximal byte
    ranges).

    ``docs`` has doc_id and text; no other column is read. Null and empty texts have no bytes. A null id is the last
    document. Rows that repeat an id are documents of their own if their texts differ (in the order of a hash of the
    text); equal ones count as one document and come out alike. An empty table gives an empty one. Texts of any length
    are read whole, in blocks.
    """
    own = identified(docs)
    runs = repeated_windows(own).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("runs"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, tag, text, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = union_of(found or [])
                kept, at = [], 0
                for start, end in spans:
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                rows.append(
                    (None if tag >= NULL_TAG else doc, b"".join(kept), len(data), [{"start": s, "end": e} for s, e in spans])
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), CLEANED_TYPES)] if rows else [pa.array([], t) for t in CLEANED_TYPES],
                names=["doc_id", "kept", "n_bytes", "spans"],
            )

    joined = own.join(runs, ["doc", "tag"], "left").select("doc", "tag", "text", "runs")
    return joined.mapInArrow(
        compute, "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>"
    )


CLEANED_TYPES = [
    pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
]


def union_of(runs: list[dict]) -> list[tuple[int, int]]:
    """Maximal byte ranges that the windows of the runs cover."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["start"] + r["n"] - 1 + LENGTH) for r in runs):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged
