"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from reqmart.llm import target_resampling as resampling
from reqmart.llm.oracle import ORACLE
from reqmart.llm.queries import QUERIES
from tests.conftest import SF_DIR, rows
from tests.llm import samples


def grams(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(samples.UPPER))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)], len(words)


def plain(docs, target, most=1):
    def buckets(texts):
        return Counter(zlib.crc32(g.encode()) % 10000 for text in texts for g in grams(text, most)[0])

    s, t = buckets(d[1] for d in docs), buckets(target)
    s_all, t_all = s.total() + 10000, t.total() + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10000)}
    out = []
    for k, (doc_id, text) in enumerate(docs):
        own, n_words = grams(text, most)
        weight = sum(gain[zlib.crc32(g.encode()) % 10000] for g in own) // max(len(own), 1)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, weight + noise, None, n_words, k])
    able = [r for r in out if r[5] >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def test_the_table(spark):
    docs = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    target = [t for _, t in samples.table_rows(SF_DIR, "benchmark", "item_id, text")]
    got = rows(QUERIES["op11_target_resampling"](spark, SF_DIR))
    assert got == sorted(plain(docs, target), key=samples.sort_key)
    assert sum(r[4] is not None for r in got) > 10


def test_the_sql():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    docs = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    target = [t for _, t in samples.table_rows(SF_DIR, "benchmark", "item_id, text")]
    got = con.execute(ORACLE["op11_target_resampling"]).fetchall()
    assert sorted(got, key=samples.sort_key) == sorted(plain(docs, target), key=samples.sort_key)


@pytest.mark.parametrize("most, batch, size", [(1, "3", 1 << 20), (1, "10000", 100), (3, "10000", 1 << 20)])
def test_awkward_documents(spark, setting, monkeypatch, most, batch, size):
    setting(spark__sql__execution__arrow__maxRecordsPerBatch=batch)
    monkeypatch.setattr(resampling, "TABLE_BYTES", size)
    docs = [d for d in samples.awkward() for _ in range(6)] + [(None, f"{k} " * 25, "a") for k in range(9)]
    target = [None, "", "alpha1 beta2 and Alpha3 é", "ü " * 30]
    table = samples.documents(spark, docs)
    got = resampling.resampled(table, spark.createDataFrame([(t, 1) for t in target], "text string, n int"), most)
    assert rows(got) == sorted(plain([d[:2] for d in docs], target, most), key=samples.sort_key)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (2, "c " * 30)], "doc_id long, text string")
    assert resampling.resampled(empty, docs).count() == 0
    assert rows(resampling.resampled(docs, empty)) == plain([(1, "a b"), (2, "c " * 30)], [])


def test_interning_tells_equal_keys_apart(monkeypatch):
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda gram: len(gram) % 3)
    words = [b"w%d" % (k * k % 50) for k in range(400)]
    table = resampling.Interned(words)
    by_slot = {}
    for word, slot in zip(words, table.slots.tolist()):
        assert by_slot.setdefault(slot, word) == word
    assert len(by_slot) == len(set(words))
    counts = Counter(words)
    assert all(table.counts[slot] == counts[word] for slot, word in by_slot.items())
    assert all(table.buckets[slot] == zlib.crc32(word) % 10000 for slot, word in by_slot.items())


def test_interning_of_many_and_of_none():
    words = [b"%d" % (k % 5000) for k in range(20_000)]
    gains = np.arange(resampling.BUCKETS)
    table = resampling.Interned(words)
    assert table.gathered(gains).tolist() == [zlib.crc32(w) % 10000 for w in words]
    assert table.bucket_counts().sum() == len(words)
    assert resampling.Interned([]).bucket_counts().sum() == 0
    assert xxhash.xxh64_intdigest(b"a") == xxhash.xxh64(b"a").intdigest()


def test_rows_that_are_equal_in_the_order_share_out_their_ranks(spark):
    same = spark.range(5000).selectExpr("7L AS score", "1L AS doc_id").repartition(8)
    from pyspark.sql import functions as F

    got = resampling.ranked(same, [F.desc("score"), F.asc_nulls_last("doc_id")])
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 5001))
