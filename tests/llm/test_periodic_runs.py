"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from reqmart.llm import periodic_runs as periodic
from reqmart.llm.queries import QUERIES
from tests.conftest import SF_DIR, rows
from tests.llm import samples


def plain_runs(words):
    """All periods compared word by word."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_row(doc_id, text):
    words = plain_words(doc_id, text)
    runs = plain_runs(words) if len(words) < 3000 else periodic.runs_of([[w.encode() for w in words]])[0]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), start, length, period, None if not runs else 1000 * length // period,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_the_table(spark):
    texts = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    got = rows(QUERIES["op12_periodic_runs"](spark, SF_DIR))
    assert got == sorted((expected_row(*r) for r in texts), key=samples.sort_key)
    assert sum(r[1] > 0 for r in got) > 10


@pytest.mark.parametrize("batch, stream", [("1", 1 << 17), ("10000", 50), ("10000", 1 << 17)])
def test_awkward_documents(spark, setting, monkeypatch, batch, stream):
    setting(spark__sql__execution__arrow__maxRecordsPerBatch=batch)
    monkeypatch.setattr(periodic, "STREAM", stream)
    docs = samples.awkward() + [(50, "la " * 500, "a"), (51, "x " + "a b c " * 9 + "a b y", "a"), (50, "la la la la la", "a")]
    got = periodic.periodic_runs(samples.documents(spark, docs)).select("doc_id", "n_words", "runs", "collapsed").collect()
    plain = []
    for doc_id, text, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = periodic.runs_of([[w.encode() for w in words]])[0] if len(words) > 3000 else plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        plain.append((doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    as_rows = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(as_rows, key=str) == sorted(plain, key=str)
    assert ("x a b c a b y" in {r[3] for r in as_rows}) is False
    assert "x a b c y" in {r[3] for r in as_rows}


def test_random_words_in_pieces(monkeypatch):
    """Runs don't depend on how a stream is cut, nor on the other texts in it."""
    draw = random.Random(12)
    for _ in range(300):
        monkeypatch.setattr(periodic, "PIECE", draw.choice([1, 3, 7, 1000]))
        texts = []
        for _ in range(draw.randint(1, 3)):
            kinds, n = draw.choice([1, 2, 3, 5]), draw.randint(0, 90)
            words = [b"%d" % draw.randrange(kinds) for _ in range(n)]
            if n > 8:
                at, p = draw.randrange(n), draw.randint(1, n // 4)
                words = [w if i < at else words[at + (i - at) % p] if p <= n - at else w for i, w in enumerate(words)]
            texts.append(words)
        assert periodic.runs_of(texts) == [plain_runs(words) for words in texts]


def test_a_word_at_a_time():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 9, 9, 9, 9, 9, 9])
    catcher = periodic.SquareCatcher(4)
    seen = []
    for k in range(len(words)):
        catcher.append(words[k : k + 1])
        seen.append(sorted(catcher.runs()))
    assert seen[10] == [] and seen[11] == [(0, 12, 3)] and seen[12] == seen[16] == [(0, 13, 3)]
    assert seen[-1] == [(0, 13, 3), (13, 6, 1)]


def test_long_runs_are_fast_and_whole():
    assert periodic.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert periodic.runs_of([[b"%d" % (i % 777) for i in range(50_000)]]) == [[(0, 50_000, 777)]]


def test_equal_hashes_do_not_count(monkeypatch):
    """All suffixes hash alike: what is caught is confirmed on the words."""
    monkeypatch.setattr(periodic.SquareCatcher, "_hashes", lambda self, starts, size: np.zeros(len(starts), np.uint64))
    words = [b"%d" % (i % 5) if 20 <= i < 60 else b"w%d" % i for i in range(90)]
    assert periodic.runs_of([words]) == [[(20, 40, 5)]]


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
