"""Token files: round trips, single documents, damage."""

from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pytest
import zstandard

from reqmart.llm import token_files
from reqmart.llm.queries import QUERIES, tokenizer
from tests.conftest import SF_DIR
from tests.llm import samples

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    return lambda text: np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def expected(docs, encode):
    start, out = 0, []
    for doc_id, text in docs:
        ids = encode(text)
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_the_table(spark, encode):
    got = sorted(map(tuple, QUERIES["op10_token_files"](spark, SF_DIR).collect()))
    assert got == expected(samples.table_rows(SF_DIR, "documents", "doc_id, text"), encode)


def test_awkward_documents(spark, encode):
    docs = samples.awkward() + [(60, "The THE the, the.. it's 'Tis <|endoftext|> éé Ǆ İ̇ क़a x́, y.", "a"), (61, "½ ² a1b2 ...a,b.c", "a")]
    got = [tuple(r) for r in token_files.token_table(samples.documents(spark, docs), PATH).collect()]
    lengths = {(i, len(encode(t)), zlib.crc32(encode(t).tobytes())) for i, t, _ in docs}
    assert {(i, n, c) for i, _, n, c in got} == lengths and len(got) == len(docs)
    in_order = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in in_order if r[0] is not None] == sorted(i for i, *_ in docs if i is not None)
    assert [r[1] for r in in_order] == [0, *np.cumsum([r[2] for r in in_order])[:-1]]
    assert token_files.token_table(samples.documents(spark, []), PATH).count() == 0


def test_any_id_is_told_from_none(spark, encode):
    low, high = -(2**63), 2**63 - 1
    docs = spark.createDataFrame([(low, "a"), (None, "b c"), (high, "d"), (0, "e")], "doc_id long, text string")
    got = sorted(map(tuple, token_files.token_table(docs, PATH, files=3).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, low, 0, high]
    assert [r[3] for r in got] == [zlib.crc32(encode(t).tobytes()) for t in ("b c", "a", "e", "d")]


def test_random_characters(encode):
    """Words are encoded apart from their text; nothing in Unicode may tell."""
    draw = np.random.default_rng(3)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x600), (0x900, 0xE00), (0x1E00, 0x2070), (0x3040, 0x3100), (0x1F300, 0x1F700)]
    texts = []
    for _ in range(400):
        low, high = ranges[draw.integers(len(ranges))]
        codes = np.where(draw.random(80) < 0.5, draw.integers(low, high, 80), draw.integers(0x20, 0x7F, 80))
        codes[draw.random(80) < 0.15] = draw.choice([0x20, 0x0A, 0x09, 0x0B, 0x1C, 0x85, 0xA0, 0x2003, 0x200D])
        texts.append("".join(map(chr, codes)))
    ids, lengths = token_files.WordEncoder(PATH).ids_of(texts, 1)
    ends = np.cumsum(lengths)
    for text, end, n in zip(texts, ends, lengths):
        assert (ids[end - n : end] == encode(text)).all(), text


@pytest.mark.parametrize("token", ["<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|x|>"])
def test_added_tokens_are_told_by_case(encode, token):
    texts = [token, f"One {token} two", f"One{token}Two, {token}, {token}. A<|B", f"{token.lower()} {token.upper()}"]
    ids, lengths = token_files.WordEncoder(PATH).ids_of(texts, 1)
    assert ids.tolist() == [i for t in texts for i in encode(t)] and lengths.tolist() == [len(encode(t)) for t in texts]


class Counting(io.BytesIO):
    fetched = 0

    def read(self, *size):
        data = super().read(*size)
        self.fetched += len(data)
        return data

    def close(self):
        pass


@pytest.fixture
def file():
    out = Counting()
    writer = token_files.SeekableWriter(out, 3)
    ids = np.random.default_rng(1).integers(0, 49_000, 500_000).astype(np.uint32)
    writer.add(np.arange(5), np.array([1, 200_000, 0, 299_000, 999]), ids)
    writer.close()
    return out, ids


def test_single_documents_and_plain_readers(file):
    out, ids = file
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read(4 * len(ids)) == ids.tobytes()
    reader = token_files.SeekableReader(out)
    before = out.fetched
    assert (reader.read(4) == ids[-999:]).all() and (reader.read(0) == ids[:1]).all()
    assert out.fetched - before < len(out.getvalue()) / 2
    assert (reader.read(1) == ids[1:200_001]).all() and (reader.read(3) == ids[200_001:-999]).all()


def test_damage_is_noticed(file):
    out, _ = file
    data = bytearray(out.getvalue())
    data[1000] ^= 1
    reader = token_files.SeekableReader(io.BytesIO(bytes(data)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.read(1)


def test_files_of_failed_attempts_do_not_count(spark, tmp_path, encode):
    docs = spark.createDataFrame([(n, f"text number {n}") for n in range(50)], "doc_id long, text string")
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    manifest = token_files.write_token_files(docs, folder, PATH, files=4)
    (tmp_path / folder.rsplit("/", 1)[1] / "stray.tokens.zst").write_bytes(b"half a file")
    got = token_files.read_token_files(manifest, folder)
    assert got.count() == 50 and manifest.count() <= 4
