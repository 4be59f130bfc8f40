"""Near duplicates and repeated byte strings against brute force."""

from __future__ import annotations

import random

import pytest

from reqmart.llm import odd_sketch_dedup as near, suffix_buckets as suffix
from reqmart.llm.components import components
from reqmart.llm.queries import QUERIES
from tests.conftest import SF_DIR, rows
from tests.llm import samples


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_near_duplicates_of_the_table(spark):
    texts = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    expected = [(i, n, c, i == c) for i, n, c in samples.near_classes(texts)]
    assert rows(QUERIES["op7_odd_sketch_dedup"](spark, SF_DIR)) == sorted(expected, key=key)


def test_near_duplicates_of_awkward_documents(spark):
    docs = samples.awkward()
    got = near.near_duplicates(samples.documents(spark, docs))
    assert rows(got) == sorted(samples.near_classes([d[:2] for d in docs]), key=key)


def test_one_document_of_each_class_stays(spark):
    docs = samples.documents(spark, samples.awkward())
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r[0] for r in rows(kept, "doc_id")]
    assert ids.count(12) <= 1 and ids.count(6) == 1 and 8 not in ids
    assert {1, 2, 3} <= set(ids)


def test_rows_without_an_id_are_documents_too(spark):
    """Texts that only rows without an id have are linked, link others, and stay once per class."""
    words = [f"w{n}" for n in range(300)]
    chain = [" ".join(words[at : at + 200]) for at in (0, 12, 24)]  # the first and the last are less alike than 85 %
    loose = " ".join(f"v{n}" for n in range(200))
    docs = [
        (1, chain[0], "a"), (None, chain[1], "a"), (2, chain[2], "a"),
        (None, loose, "b"), (None, loose + " and a tail", "b"), (None, loose, "c"),
        (3, "a text of five words and more", "a"), (None, "a text of five words and more", "a"),
        (None, "an only text that is like no other", "a"), (None, None, "a"), (None, "", "a"), (4, None, "a"),
        (5, "one of the texts of id five", "a"), (5, "a text of five words and more", "a"),
    ]
    table = samples.documents(spark, docs)
    got = rows(near.near_duplicates(table))
    assert got == sorted(samples.near_classes([d[:2] for d in docs]), key=key)
    assert {c for i, _, c in got if i in (1, 2)} == {1}
    kept = rows(near.deduplicated(table), "doc_id", "text")
    assert len(kept) == 8
    loose_kept = [t for i, t in kept if i is None and t and t.startswith(loose)]
    assert len(loose_kept) == 1
    assert set(kept) == {
        (1, chain[0]), (None, loose_kept[0]), (3, docs[6][1]), (None, docs[8][1]), (None, None), (None, ""), (4, None),
        (5, docs[12][1]),
    }


def test_kept_is_told_by_the_id_alone(spark):
    text = " ".join(f"w{n}" for n in range(90))
    docs = [(1, text, "a"), (1, text + " tail", "a"), (2, text, "b"), (None, text, "b"), (None, None, "b"), (3, "", "c")]
    got = near.classes(samples.documents(spark, docs))
    assert rows(got, "doc_id", "component_id", "kept") == sorted(
        [(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, None), (None, None, None), (3, 3, True)], key=key
    )
    assert sum(r["stays"] for r in got.collect()) == 3


@pytest.mark.parametrize("bound", [2_000_000, 3000])
def test_near_copies_that_stay_apart(spark, monkeypatch, bound):
    """They are compared within tasks: the search gives fewer links than there are documents, however it is cut."""
    from reqmart.llm import ngram_join

    monkeypatch.setattr(ngram_join, "FAMILY_SHINGLES", bound)
    draw = random.Random(9)
    base = [f"b{n}" for n in range(150)]
    docs = [(n, " ".join(w if draw.random() > 0.02 else f"x{n}" for w in base)) for n in range(300)]
    counted = []
    searched = near.searched
    monkeypatch.setattr(near, "searched", lambda *a: counted.append(searched(*a).cache()) or counted[-1])
    got = rows(near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    expected = samples.near_classes(docs)
    assert got == sorted(expected, key=key)
    assert 100 < len({c for _, _, c in expected}) < 290
    assert counted[0].count() < len(docs)


def test_a_chain_of_links_is_one_class(spark):
    words = [f"w{n}" for n in range(400)]
    texts = [(n, " ".join(words[n * 12 : n * 12 + 200])) for n in range(16)]
    got = near.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r[2] for r in got.collect()} == {0}


@pytest.mark.parametrize("at_once", [200_000, 4])
@pytest.mark.parametrize("links, expected", [
    ([], {}),
    ([(1, 2), (2, 3), (5, 4), (7, 7)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(n, n + 1) for n in range(30)], {n: 0 for n in range(31)}),
])
def test_components(spark, monkeypatch, links, expected, at_once):
    """In one task, or in many that leave rounds to do."""
    monkeypatch.setattr("reqmart.llm.components.TIED_AT_ONCE", at_once)
    found = components(spark.createDataFrame(links, "u long, v long"))
    assert dict(map(tuple, found.collect())) == expected


def test_repeats_of_the_table(spark):
    texts = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    got = rows(suffix.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")))
    plain = [(i, bytes(kept), [(s["start"], s["end"]) for s in spans]) for i, kept, _, spans in got]
    assert plain == sorted(samples.without_repeats(texts), key=key)


@pytest.mark.parametrize("batch", ["1", "7", "10000"])
def test_repeats_of_awkward_documents(spark, setting, batch):
    """Small batches put the borders of buckets between them."""
    setting(spark__sql__execution__arrow__maxRecordsPerBatch=batch)
    docs = [d for d in samples.awkward(60) if d[0] is not None] + [(20, "ab" * 150, "a"), (21, "zz" + "ab" * 120 + "q", "a")]
    got = rows(suffix.without_repeats(samples.documents(spark, docs)))
    once = samples.without_repeats([d[:2] for d in dict.fromkeys(docs)])
    expected = [r for r in once for _ in range(2 if r[0] == 12 else 1)]
    plain = [(i, bytes(kept), [(s["start"], s["end"]) for s in spans]) for i, kept, _, spans in got]
    assert plain == sorted(expected, key=key)


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 300)
    docs = [(n, ("the same long passage of text " * 3 + f"{n} ") * 12) for n in range(6)]
    got = rows(suffix.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert [(r[0], bytes(r[1])) for r in got] == [(i, k) for i, k, _ in samples.without_repeats(docs)]


def test_a_null_id_is_the_last_document(spark):
    text = " ".join(f"word{n}" for n in range(40))
    got = suffix.without_repeats(spark.createDataFrame([(None, text), (5, text)], "doc_id long, text string"))
    assert {r["doc_id"]: len(r["kept"]) for r in got.collect()} == {5: len(text), None: 0}


def test_any_id_is_told_from_none(spark):
    low, high = -(2**63), 2**63 - 1
    shared, alone = (" ".join(f"{w}{n}" for n in range(40)) for w in ("word", "other"))
    data = [(None, shared), (high, shared), (None, alone), (high, "x"), (low, alone), (low, "y" * 99)]
    got = suffix.without_repeats(spark.createDataFrame(data, "doc_id long, text string"))
    lengths = sorted((str(r["doc_id"]), len(r["kept"])) for r in got.collect())
    assert lengths == sorted([
        ("None", 0), (str(high), len(shared)), ("None", 0), (str(high), 1), (str(low), len(alone)), (str(low), 99)
    ])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(empty).count() == 0
    assert near.deduplicated(empty).count() == 0
    assert suffix.without_repeats(empty).count() == 0
