"""Awkward documents, and plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that the operators use for columns of their own.
CLASHING = ["size", "copies", "doc", "id", "tail", "node", "n", "text_", "slot", "place", "words", "rows", "path", "salt"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def documents(spark, rows):
    """Documents (doc_id, text, source) with columns of clashing names beside them."""
    data = [(i, t, "en", s, None if t is None else len(t), *("x" for _ in CLASHING)) for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def awkward(words=40):
    """Nulls, empty and blank texts, short ones, a long one, ties, repeated rows, and near copies."""
    base = " ".join(f"alpha{n} Beta{n % 7}" for n in range(words))
    near = base.replace("alpha3 ", "other ")
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (5, "One two", "b"), (6, base, "a"),
        (7, base.upper(), None), (8, near, "a"), (9, "x" * 3000, "b"), (10, base + " " + "tail " * 4000, "b"),
        (11, "é ü 日本   " + base, "c"), (12, base + ".", "é"), (12, base + ".", "é"), (None, base, "a"),
        (None, "lonely words of no document at all here", None), (13, "one two three four five", "a"),
        (14, "one two three four five", "zz"), (15, "\x00\x1c odd \x1f bytes \x0b here", ""),
    ]


def table_rows(sf_dir, name, columns):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet' ORDER BY 1").fetchall()


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_classes(rows, percent=85, size=5):
    """Component and set size of each (doc_id, text), all pairs compared."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if sets[i]:
            for j in range(i):
                if sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
        by_id[doc_id].append(i)
    firsts = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (firsts.get(root(i)), doc_id) if x is not None]
        firsts[root(i)] = min(known) if known else None
    return [(doc_id, len(sets[i]), firsts[root(i)] if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def without_repeats(rows, length=100):
    """Remaining bytes and removed ranges of each (doc_id, text), in order of the ids."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((doc_id, bytes(c for c, g in zip(data, gone) if not g), spans))
    return out


def contained(rows, items, percent=80):
    """Pairs of a document and an item of which it has so many percent of the shingles."""

    def runs(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [(i, runs(t)) for i, t in items]
    found = set()
    for doc_id, text in rows:
        own = runs(text)
        found |= {(doc_id, i, len(s), len(s & own)) for i, s in sets if s and 100 * len(s & own) >= percent * len(s)}
    return found
