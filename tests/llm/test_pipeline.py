"""The corpus pipeline against a plain version of its stages."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np

import corpus_pipeline
from reqmart.llm import ordinal_quality as quality
from reqmart.llm.oracle import MIX
from reqmart.llm.queries import LEAST_TAIL, tokenizer
from tests.conftest import SF_DIR
from tests.llm import samples


def rejected(texts, labels):
    """Ids of documents that a model fitted here doesn't take for good."""
    def features(text):
        return np.array(sorted({quality.hashed(t) for t in quality.tokens_of(text)}), dtype=np.int64)

    grade = {i: 0 if q == 0 else 1 if t else 2 for i, q, t in labels}
    rated = sorted(i for i in grade if i in texts)
    model = quality.learn([features(texts[i]) for i in rated], np.array([grade[i] for i in rated]), 3)
    scores = np.array([sum(model.weights.get(int(k), 0.0) for k in features(t)) for t in texts.values()])
    return {i for i, tail in zip(texts, model.tails(scores)[:, 1].round(6)) if tail < LEAST_TAIL}


def test_run_equals_a_plain_version(spark):
    from tokenizers import Tokenizer

    texts = dict(samples.table_rows(SF_DIR, "documents", "doc_id, text"))
    out = rejected(texts, samples.table_rows(SF_DIR, "labels", "doc_id, quality, toxic"))
    kept = {i: t for i, t in texts.items() if i not in out}
    kept = {i: kept[i] for i, _, first in samples.near_classes(list(kept.items())) if i == first}
    leaks = samples.contained(list(kept.items()), samples.table_rows(SF_DIR, "benchmark", "item_id, text"))
    kept = {i: t for i, t in kept.items() if i not in {leak[0] for leak in leaks}}
    duck = duckdb.connect()
    ids = ", ".join(map(str, kept))
    mixed = duck.execute(
        f"WITH docs AS (SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet' WHERE doc_id IN ({ids})), {MIX} "
        "SELECT doc_id, copies FROM mix ORDER BY doc_id"
    ).fetchall()
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    expected, start = [], 0
    for doc_id, copies in mixed:
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 1], dtype="<u4")
        for _ in range(copies):
            expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == expected


def test_stages_bear_awkward_documents(spark):
    docs = samples.documents(spark, samples.awkward())
    for table in (docs, docs.where("false")):
        columns = table.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF_DIR)
            assert table.columns == columns
        out = corpus_pipeline.STAGES[-1][1](spark, table, SF_DIR)
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == table.count()
