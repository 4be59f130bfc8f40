"""Token ids in seekable files: independent zstandard frames with a seek table at the end.

A file holds the ids of its documents, one after the other, as little-endian unsigned 32-bit integers, cut into frames
of ``FRAME_IDS`` ids that decompress on their own. Two skippable frames follow, so that any zstandard reader can read
the whole file as well: the document index (id, token count and whether the id is null, per document, zstandard-compressed) and the seek
table in the public seekable format (compressed size, content size and low 32 bits of the content's xxh64, per frame).
A reader fetches the two tables, then only the frames that hold the documents asked for, and checks each frame against
its checksum.

Spark sorts the documents by id into ranges; each task encodes its range and writes one file. A task that is run again
writes a file of another name, and the manifest (a table of one row per file, written by Spark) names those that
count, so lost executors and repeated tasks do no harm.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from reqmart.session import qualified, scratch_folder

# Fixed values of the seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

FRAME_IDS = 65536
#: Words whose ids a worker keeps; beyond it starts anew. Bounds memory only.
KEPT_WORDS = 400_000
#: ASCII characters that Python's split() takes for white space and the tokenizer does not.
NOT_BLANK = "\x1c\x1d\x1e\x1f"
#: Added tokens begin with this; the tokenizer tells their case.
ADDED = "<|"

MANIFEST = "path string, first_id long, first_hash long, documents long, tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Numbered(dict):
    """Numbers words in the order in which they are first looked up; ``fresh`` has those not learned yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Ragged:
    """Many short arrays of ids, one after the other."""

    def __init__(self):
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def extend(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of these numbers, joined, and their lengths."""
        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(lengths.sum())], lengths


class WordEncoder:
    """Ids of whole texts by way of their words.

    The tokenizer normalises character by character and never joins across white space, or across the end of a run of
    letters, so a text's ids are those of its words in turn, and those of "word," are those of "word" and of ",". Each
    distinct word goes through the tokenizers library once while it is kept.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.encode = tokenizer.encode_batch_fast
        self.marks = {mark: tokenizer.encode(mark, add_special_tokens=False).ids for mark in ".,"}
        pieces = tokenizer.get_vocab()
        self.ends_word = np.zeros(max(pieces.values()) + 1, dtype=bool)
        self.ends_word[[i for piece, i in pieces.items() if piece.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words, self.stems = Numbered(), Numbered()
        self.word_ids, self.stem_ids = Ragged(), Ragged()

    def _learn_stems(self) -> None:
        fresh, self.stems.fresh = self.stems.fresh, []
        # A stem of letters only is one word to the tokenizer: many go in one text, and their last pieces tell them apart.
        letters = [w for w in fresh if w.isalpha()]
        lines = [" ".join(letters[at : at + 500]) for at in range(0, len(letters), 500)]
        joined = self._flat(self.encode(lines, add_special_tokens=False))
        ends = np.flatnonzero(self.ends_word[joined]) + 1
        if len(ends) != len(letters):  # a letter that is normalised to something else
            each = self.encode(letters, add_special_tokens=False)
            joined, ends = self._flat(each), np.cumsum([len(e.ids) for e in each], dtype=np.int64)
        others = self.encode([w for w in fresh if not w.isalpha()], add_special_tokens=False)
        found = Ragged()
        found.extend(np.diff(ends, prepend=0), joined)
        found.extend(np.array([len(e.ids) for e in others], dtype=np.int64), self._flat(others))
        places, is_letters = np.zeros(len(fresh), dtype=np.int64), np.array([w.isalpha() for w in fresh], dtype=bool)
        places[is_letters] = np.arange(len(letters))
        places[~is_letters] = len(letters) + np.arange(len(others))
        ids, lengths = found.take(places)
        self.stem_ids.extend(lengths, ids)

    @staticmethod
    def _flat(encoded: list) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, dtype=np.uint32) for e in encoded)])

    def _learn(self) -> None:
        fresh, self.words.fresh = self.words.fresh, []
        stems, marks = zip(*map(split_mark, fresh))
        numbers = np.fromiter(map(self.stems.__getitem__, stems), dtype=np.int64, count=len(stems))
        if self.stems.fresh:
            self._learn_stems()
        ids, lengths = self.stem_ids.take(numbers)
        marked = [self.marks.get(m, []) for m in marks]
        mark_lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        at = np.repeat(np.cumsum(lengths), mark_lengths)
        self.word_ids.extend(lengths + mark_lengths, np.insert(ids, at, [i for m in marked for i in m]))

    def ids_of(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end_id``, and how many there are of each."""
        if len(self.words) > KEPT_WORDS:
            self._forget()
        pieces = [words_of(text or "") for text in texts]
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        numbers = np.fromiter(
            map(self.words.__getitem__, chain.from_iterable(pieces)), dtype=np.int64, count=int(counts.sum())
        )
        if self.words.fresh:
            self._learn()
        ids, lengths = self.word_ids.take(numbers)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return np.insert(ids, ends, np.uint32(end_id)), np.diff(ends, prepend=0) + 1


def worker_encoder(tokenizer_path: str) -> WordEncoder:
    """The encoder of this worker process, which serves many tasks. It is kept with the tokenizers module, because
    functions that travel by value get new globals in each task.
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_word_encoders", {})
    if tokenizer_path not in kept:
        kept[tokenizer_path] = WordEncoder(tokenizer_path)
    return kept[tokenizer_path]


def split_mark(word: str) -> tuple[str, str]:
    """The word and a full stop or comma right after its last letter; plain ASCII in lower case, as the tokenizer has
    it, but for words that may hold an added token, which it looks for before that.
    """
    mark = ""
    if word[-1] in ".," and word[-2:-1].isalpha():
        word, mark = word[:-1], word[-1]
    return (word.lower() if word.isascii() and ADDED not in word else word), mark


def words_of(text: str) -> list[str]:
    """Pieces of the text between which the tokenizer cuts for certain; blanks are left out."""
    if any(c in text for c in NOT_BLANK):
        return [w for w in text.split(" ") if w]
    return text.split()


class SeekableWriter:
    """Write one file: ``add`` ids in document order, then ``close``."""

    def __init__(self, out, level: int):
        self.out, self.compressor = out, zstandard.ZstdCompressor(level=level)
        self.pending, self.pending_ids, self.frames, self.index = [], 0, [], []

    def add(self, doc_ids: list[int | None], n_tokens: np.ndarray, ids: np.ndarray) -> None:
        no_id = [i is None for i in doc_ids]
        self.index.append(np.array([[i or 0 for i in doc_ids], n_tokens, no_id], dtype="<i8"))
        self.pending.append(ids)
        self.pending_ids += len(ids)
        if self.pending_ids >= FRAME_IDS:
            self._flush(whole_frames=True)

    def _flush(self, whole_frames: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.pending]).astype("<u4")
        upto = len(ids) // FRAME_IDS * FRAME_IDS if whole_frames else len(ids)
        for at in range(0, upto, FRAME_IDS):
            content = ids[at : min(at + FRAME_IDS, upto)].tobytes()
            frame = self.compressor.compress(content)
            self.out.write(frame)
            self.frames.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.pending, self.pending_ids = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(whole_frames=False)
        index = np.concatenate([np.zeros((3, 0), "<i8"), *self.index], axis=1).astype("<i8")
        packed = self.compressor.compress(index.tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<III", len(packed) + 8, 0, 0)  # the index, as the format asks, is a frame without content
        footer = struct.pack("<IBI", len(self.frames) + 1, HAS_CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)) + table + footer)


class SeekableReader:
    """Read documents of one file without decompressing the others."""

    def __init__(self, file):
        self.file, self.decompressor = file, zstandard.ZstdDecompressor()
        file.seek(0, 2)
        end = file.tell()
        count, flags, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != FOOTER_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table")
        table = np.frombuffer(self._bytes(end - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.frames = table[:-1]
        packed = self._bytes(int(self.offsets[-2]) + 8, int(table[-1, 0]) - 8)
        index = np.frombuffer(self.decompressor.decompress(packed), "<i8").reshape(3, -1)
        self.doc_ids, self.n_tokens, self.no_id = index
        self.starts = np.concatenate([[0], np.cumsum(self.n_tokens)])
        self.at, self.content = -1, np.zeros(0, "<u4")

    def _bytes(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def _frame(self, k: int) -> np.ndarray:
        """Ids of a frame; the last one used is kept, for the next document in it."""
        if k != self.at:
            size, length, checksum = (int(x) for x in self.frames[k])
            content = self.decompressor.decompress(self._bytes(int(self.offsets[k]), size), max_output_size=length)
            if len(content) != length or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} is damaged")
            self.at, self.content = k, np.frombuffer(content, "<u4")
        return self.content

    def chunks(self, place: int) -> Iterator[np.ndarray]:
        """Ids of the document at this place of the file, a frame's part at a time."""
        start, end = int(self.starts[place]), int(self.starts[place + 1])
        while start < end:
            k, within = divmod(start, FRAME_IDS)
            part = self._frame(k)[within : within + end - start]
            yield part
            start += len(part)

    def read(self, place: int) -> np.ndarray:
        return np.concatenate(list(self.chunks(place)))


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder with a scheme."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, files: int | None = None, level: int = 3
) -> DataFrame:
    """Write the ids of all texts below ``folder`` (shared by all executors) and return the manifest, one row per
    file.

    Files hold ascending ranges of doc_id: null ids first, equal ids by the text's hash. A null text gives ``end_id``
    alone. Only doc_id and text are read. An empty table gives an empty manifest. Texts of any length are encoded whole
    and may span any number of frames. A folder without a scheme is one of Spark's default file system.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        documents = tokens = 0
        first = None
        store, place = open_store(folder)
        path = f"{place}/{uuid.uuid4().hex}.tokens.zst"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = worker_encoder(tokenizer_path)
                store.create_dir(place, recursive=True)
                writer = SeekableWriter(store.open_output_stream(path, compression=None), level)
            doc_ids = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 1024):
                ids, n_tokens = encoder.ids_of(batch.column(2)[at : at + 1024].to_pylist(), end_id)
                writer.add(doc_ids[at : at + 1024], n_tokens, ids)
                documents, tokens = documents + len(n_tokens), tokens + len(ids)
            first = first or (doc_ids[0], batch.column(1)[0].as_py())
        if writer is not None:
            writer.close()
            writer.out.close()
            row = {"path": path, "first_id": first[0], "first_hash": first[1], "documents": documents, "tokens": tokens}
            yield pa.RecordBatch.from_pylist([row])

    # The text's hash lets a range end between rows of one id.
    named = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("hash"), "text")
    ranged = named.repartitionByRange(files, "id", "hash").sortWithinPartitions("id", "hash", "text")
    written = ranged.mapInArrow(write, MANIFEST)
    written.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document what the files hold: doc_id, start (the ids of all documents before it, over all files), n_tokens,
    crc32 of its ids.

    Each file is told where it starts before it is read, by a sum over the manifest, a row per file.
    """
    spark = manifest.sparkSession
    folder, files = qualified(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = Window.orderBy("first_id", "first_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("file_start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file_start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, _ = open_store(folder)
                with store.open_input_file(path) as file:
                    reader = SeekableReader(file)
                    for at in range(0, len(reader.doc_ids), 10_000):
                        places = range(at, min(at + 10_000, len(reader.doc_ids)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[at : at + 10_000], mask=reader.no_id[at : at + 10_000] == 1),
                                pa.array(file_start + reader.starts[at : at + len(places)]),
                                pa.array(reader.n_tokens[at : at + 10_000]),
                                pa.array([crc32(reader.chunks(p)) for p in places], pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return placed.repartition(files, "path").mapInArrow(read, DOCUMENTS)


def crc32(chunks: Iterator[np.ndarray]) -> int:
    value = 0
    for chunk in chunks:
        value = zlib.crc32(chunk.tobytes(), value)
    return value


def token_table(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **settings) -> DataFrame:
    """Write the token files of ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32 per document.

    Without a folder the files are intermediate ones, which go when the run or the application ends.
    """
    folder = folder or scratch_folder(docs.sparkSession)
    return read_token_files(write_token_files(docs, folder, tokenizer_path, **settings), folder)
