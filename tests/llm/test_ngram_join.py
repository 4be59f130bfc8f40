"""The n-gram Jaccard join against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from reqmart.llm import ngram_join as join
from reqmart.llm.queries import QUERIES
from tests.conftest import SF_DIR, rows
from tests.llm import samples

KEY = samples.sort_key


def test_the_table(spark):
    texts = samples.table_rows(SF_DIR, "documents", "doc_id, text")
    expected = samples.near_classes(texts, size=4)
    assert rows(QUERIES["op13_ngram_join"](spark, SF_DIR)) == sorted(expected, key=KEY)


@pytest.mark.parametrize("bound", [2_000_000, 100])
def test_awkward_documents(spark, monkeypatch, bound):
    """A small bound cuts every family into parts."""
    monkeypatch.setattr(join, "FAMILY_SHINGLES", bound)
    docs = samples.awkward(60)
    words = [f"w{n}" for n in range(400)]
    docs += [(100 + n, " ".join(words[n * 9 : n * 9 + 200 - n]), "a") for n in range(16)]  # a chain of links
    docs += [(None, " ".join(words[40:190]), "a"), (130, "a b c d", "a"), (131, "A b c  d", "b"), (132, "a b c", "b")]
    got = join.linked(samples.documents(spark, docs))
    assert rows(got) == sorted(samples.near_classes([d[:2] for d in docs], size=4), key=KEY)


def test_a_group_that_stays_apart(spark):
    """Copies that are alike, but mostly not enough: each pair has to be looked at, and few links come out."""
    draw = random.Random(4)
    base = [f"b{n}" for n in range(80)]
    docs = [(n, " ".join(w if draw.random() > 0.03 else f"x{n}" for w in base)) for n in range(150)]
    got = join.linked(spark.createDataFrame(docs, "doc_id long, text string"))
    expected = samples.near_classes(docs, size=4)
    assert len({c for _, _, c in expected}) > 20
    assert rows(got) == sorted(expected, key=KEY)


def test_empty_table(spark):
    assert join.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def connected(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(a)] = root(b)
    names = {}
    return [names.setdefault(root(i), i) for i in range(n)]


@pytest.mark.parametrize("mu", [0.0085, 0.3, 1.0])
def test_search(monkeypatch, mu):
    """The larger the constant, the more lists are merged by the heap."""
    monkeypatch.setattr(join, "MU", mu)
    draw = random.Random(int(mu * 100))
    for _ in range(60):
        bases = [draw.sample(range(3000), draw.randint(1, 120)) for _ in range(3)]
        sets = []
        for _ in range(draw.randint(2, 40)):
            own = set(draw.choice(bases))
            for _ in range(draw.randint(0, 12)):
                if own and draw.random() < 0.5:
                    own.discard(draw.choice(sorted(own)))
                own.add(draw.randrange(3000))
            sets.append(own)
        sets.sort(key=len)
        sides = [None] * len(sets) if draw.random() < 0.5 else [draw.randrange(2) for _ in sets]
        similar = [
            (i, j)
            for i in range(len(sets))
            for j in range(i)
            if (sides[i] is None or sides[i] != sides[j]) and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
        ]
        found = join.links_among([np.array(sorted(s)) for s in sets], sides, 85)
        assert len(found) < len(sets)
        assert connected(len(sets), found) == connected(len(sets), similar)


def test_merging_skips_but_counts_all():
    draw = random.Random(1)
    for _ in range(200):
        lists = [sorted(draw.sample(range(40), draw.randint(1, 30))) for _ in range(draw.randint(1, 9))]
        least = draw.randint(1, len(lists))
        plain = {e: sum(e in entries for entries in lists) for e in range(40)}
        assert join.merged(lists, least) == {e: n for e, n in plain.items() if n >= least}
