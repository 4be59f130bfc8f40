"""Runs of words that repeat with a period, found by catching squares online.

A stream of words is watched by catchers. At each level k, every block of L = 2**k words that starts at a multiple of L
becomes a catcher as soon as it is complete. A square (a stretch of q words and the same q words after it) with
2L - 1 <= q <= 4L - 2 has such a block in its first half, and the block's copy q words later. So each appended word
compares, at each level, the suffix of L words that it ends with the two catchers that lie at such a distance; a match
is a piece of period q. Matches of neighbouring catchers at one distance merge into one stretch, whose ends are then
compared word by word: it is a run if it is long enough and no smaller period explains it.

Suffixes are compared by rolling hashes, which never miss a match; what they catch is confirmed on the words. Words come
in pieces of any length, and the runs don't depend on how the stream is cut. A word costs two comparisons at each level;
what is kept besides the words are the stretches that are still open or long enough.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reqmart.llm.text_bytes import mix

#: A run has at least so many words, and its period so many times.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Words that a catcher takes in at a time, and words of documents that share a stream.
PIECE = 1 << 16
STREAM = 1 << 17
#: Base of the rolling hash, odd, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A match is a number: its distance above, its block below this bit.
BLOCK_BITS = 40

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SquareCatcher:
    """Runs in a stream of word numbers, of periods up to ``most_period``."""

    def __init__(self, most_period: int):
        self.levels = 0
        while 2 ** (self.levels + 1) - 1 <= most_period:
            self.levels += 1
        self.words = np.zeros(0, dtype=np.int64)
        self.sums = np.zeros(1, dtype=np.uint64)  # of hashed words times powers of the base
        self.scales = np.ones(1, dtype=np.uint64)  # inverse powers
        self.power = np.uint64(1)
        # First and last match of each stretch, by level.
        self.stretches = [(np.zeros(0, dtype=np.int64),) * 2 for _ in range(self.levels)]

    def append(self, words: np.ndarray) -> None:
        """Take in words and catch the squares that they complete."""
        for at in range(0, len(words), PIECE):
            self._append(words[at : at + PIECE])

    def _append(self, words: np.ndarray) -> None:
        seen, n = len(self.words), len(words)
        powers = np.cumprod(np.concatenate([[self.power], np.full(n, BASE, dtype=np.uint64)]), dtype=np.uint64)
        scales = np.cumprod(np.concatenate([self.scales[-1:], np.full(n, INVERSE, dtype=np.uint64)]), dtype=np.uint64)
        values = mix(words.astype(np.uint64) + np.uint64(BASE)) * powers[:-1]
        self.power = powers[-1]
        self.words = np.concatenate([self.words, words])
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(values, dtype=np.uint64)])
        self.scales = np.concatenate([self.scales, scales[1:]])
        for level in range(self.levels):
            self._catch(level, seen)

    def _catch(self, level: int, seen: int) -> None:
        size = 1 << level
        starts = np.arange(max(0, seen - size + 1), len(self.words) - size + 1)
        starts = starts[starts >= 2 * size - 1]  # of the suffixes that new words end
        if not len(starts):
            return
        suffixes = self._hashes(starts, size)
        nearest = (starts - (2 * size - 1)) >> level
        first = int(nearest[0]) - 1
        blocks = self._hashes(np.arange(max(first, 0), int(nearest[-1]) + 1) << level, size)
        found = []
        for block in (nearest, nearest - 1):
            hit = np.flatnonzero((block >= 0) & (blocks[np.maximum(block - max(first, 0), 0)] == suffixes))
            found.append((starts[hit] - (block[hit] << level)) << BLOCK_BITS | block[hit])
        new = np.concatenate(found)
        begin, end = self.stretches[level]
        if not len(new) and not len(begin):
            return
        begin, end = np.concatenate([begin, new]), np.concatenate([end, new])
        order = np.argsort(begin)
        begin, end = begin[order], end[order]
        opens = np.concatenate([[True], begin[1:] != end[:-1] + 1])
        last = np.flatnonzero(np.concatenate([opens[1:], [True]]))
        begin, end = begin[opens], end[last]
        # A run has four matches in a row at least. A shorter stretch stays while its next match may come.
        period, block = end >> BLOCK_BITS, end & ((1 << BLOCK_BITS) - 1)
        kept = (end - begin >= 3) | (((block + 2) << level) + period > len(self.words))
        self.stretches[level] = begin[kept], end[kept]

    def _hashes(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.scales[starts]

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, periods ascending."""
        words, found = self.words, []
        seen: set[tuple[int, int]] = set()
        painted = np.full(len(words), -1, dtype=np.int64)
        for level, (begins, ends) in enumerate(self.stretches):
            long = ends - begins >= 3
            for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
                q, size = begin >> BLOCK_BITS, 1 << level
                low = (begin & ((1 << BLOCK_BITS) - 1)) << level
                high = ((end & ((1 << BLOCK_BITS) - 1)) + 1) << level
                if any(self._explains(found[k], low, high, q) for k in {painted[low], painted[high - 1]} if k >= 0):
                    continue
                # Beyond the neighbouring blocks, which do not match, the stretch can't reach.
                low, high = max(0, low - size), min(len(words) - q, high + size)
                same = np.concatenate([[False], words[low:high] == words[low + q : high + q], [False]])
                edges = np.flatnonzero(same[1:] != same[:-1])
                for start, stop in zip((edges[0::2] + low).tolist(), (edges[1::2] + low).tolist()):
                    length = stop - start + q
                    if length >= max(LEAST_WORDS, LEAST_TIMES * q) and (start, length) not in seen:
                        seen.add((start, length))
                        painted[start : start + length] = len(found)
                        found.append((start, length, q))
        return found

    @staticmethod
    def _explains(run: tuple[int, int, int], low: int, high: int, period: int) -> bool:
        """Whether a stretch of this period is that of a multiple of the run's period, within the run."""
        start, length, q = run
        return period % q == 0 and start <= low and high + period <= start + length


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with a tail that repeats in every tenth document by the checksum of its id.

    A document without an id stays as it is.
    """
    n, number = len(words), zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    if doc_id is None or not n or number % 10:
        return words
    seed = number // 10
    at = seed % n
    period = 1 + (n - at) // (3 + seed % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start and period. The texts share one stream, parted by words
    of their own.
    """
    numbers: dict[bytes, int] = {}
    longest = max(map(len, texts), default=0)
    catcher = SquareCatcher(longest // LEAST_TIMES)
    ends = np.cumsum([len(words) + 1 for words in texts])
    stream = []
    for k, words in enumerate(texts):
        stream.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, count=len(words)))
        stream.append(np.array([-1 - k], dtype=np.int64))
    catcher.append(np.concatenate([np.zeros(0, np.int64), *stream]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in catcher.runs():
        k = int(np.searchsorted(ends, start, side="right"))
        out[k].append((start - int(ends[k] - len(texts[k]) - 1), length, period))
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those after the first period of a run, joined by blanks."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def periodic_runs(docs: DataFrame, synthetic: bool = False) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed text per document.

    ``docs`` has doc_id and text; no other column is read. Words are parted by blanks and ASCII control white space. A
    run is a longest stretch with a smallest period that it holds four times at least, and six words at least.
    ``synthetic`` lets some texts repeat (``made_periodic``), to have runs to find. Null, empty and blank texts have no
    words, no runs and an empty collapsed text. Rows are told apart, whether ids repeat or are null; an empty table
    gives an empty one. A text of any length is one stream and is read piece by piece; runs never cross texts. Nothing
    is shuffled: a task that is run again gives the same rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                upto, total, stream = at, 0, []
                while upto < len(ids) and total < STREAM:
                    words = (texts[upto].as_py() or "").encode().split()
                    stream.append(made_periodic(words, ids[upto]) if synthetic else words)
                    total, upto = total + len(words), upto + 1
                runs = runs_of(stream)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[at:upto], pa.int64()),
                        pa.array([len(words) for words in stream], pa.int64()),
                        pa.array([[dict(zip(RUN_NAMES, r)) for r in own] for own in runs], RUN_TYPE),
                        pa.array([collapsed(w, r).decode() for w, r in zip(stream, runs)], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at = upto

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(find, RUNS)


RUN_NAMES = ["start", "length", "period"]
RUN_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in RUN_NAMES]))
