"""Quality grades by ordinal cumulative-link regression on hashed text.

One score per text, a sum of weights shared by all grades, and ordered thresholds: P(grade <= k) is the logistic
function of threshold k minus score. That gives the expected grade and the probability of a grade of at least k, by
which documents are selected. Texts are hashed sets of words and punctuation runs, and three marks of shape
(repetition, variety, capitals); whole texts count, whatever their length.

The model is fitted on a bounded sample of the rated documents, ``SAMPLE`` at most, those with the smallest hash of
their id; one task fits it, from hashed numbers, and the driver gets its few weights. Scoring is one pass over the
documents without a shuffle.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 12_000
DIMENSIONS = 1 << 18
#: Tokens whose weight a worker remembers; beyond it starts anew. Bounds memory only.
KEPT_TOKENS = 100_000

WORDS = re.compile(r"[^\W\d_]+")
RUNS = re.compile(r"([^\w\s])\1+")


def tokens_of(text: str) -> set[str]:
    """Distinct lower-case words, their beginnings, runs of one punctuation mark, and marks of shape in tenths."""
    words = WORDS.findall(text)
    tokens = set(map(str.lower, set(words)))
    distinct = len(tokens)
    long = [w for w in tokens if len(w) > 4]
    tokens.update({w[:4] + "-" for w in long}, {w[:5] + "-" for w in long})
    tokens.update(m[0][:3] for m in RUNS.finditer(text))
    if " | " in text:
        tokens.add(" | ")
    if n := len(words):
        tokens.add(f"#same {10 * sum(map(operator.eq, words, words[1:])) // n}")
        tokens.add(f"#capitals {10 * sum(w.isupper() and len(w) > 1 for w in words) // n}")
        if n >= 30:
            tokens.add(f"#varied {10 * min(n, 300) * distinct // (n * min(n, 300))}")
    return tokens


def hashed(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % DIMENSIONS


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    """Weights by hash, and the thresholds between the grades 0, 1, ..."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a column each."""
        return 1 - logistic(self.thresholds[None, :] - scores[:, None])

    def score(self, docs: DataFrame, at_least: int | None = None, keep: list[str] | None = None) -> DataFrame:
        """A row per document: the columns ``keep`` (default: all) in the struct ``doc``, expected_grade, tail.

        ``tail`` is the probability of a grade of ``at_least`` (default: the best grade). ``docs`` has text; a null
        text counts as empty, and an empty one has the score 0. Repeated rows are scored alike. Other columns only
        travel in ``doc``.
        """
        weights, thresholds, tails = self.weights, self.thresholds, self.tails
        chosen = len(thresholds) if at_least is None else at_least
        kept = docs.columns if keep is None else keep
        packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("doc"), "text")

        class Weights(dict):
            def __missing__(self, token: str) -> float:
                value = self[token] = weights.get(hashed(token), 0.0)
                return value

        def grades(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            known = Weights()
            for texts in batches:
                scores = np.zeros(len(texts))
                for i, text in enumerate(texts):
                    scores[i] = sum(map(known.__getitem__, sorted(tokens_of(text or ""))))
                    if len(known) > KEPT_TOKENS:
                        known.clear()
                above = tails(scores)
                yield pd.DataFrame(
                    {"expected_grade": above.sum(axis=1).round(6), "tail": above[:, chosen - 1].round(6)}
                )

        graded = F.pandas_udf(grades, "expected_grade double, tail double")
        return packed.select("doc", graded("text").alias("graded")).select("doc", "graded.*")


def fit(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE) -> OrdinalModel:
    """Fit on at most ``sample`` rated documents, the same ones in every run.

    ``ratings`` has doc_id and grade (0 to ``grades`` - 1); rows with a null in either, or a grade out of range, and
    documents with a null text are left out. Of a document rated twice, each rating counts; of an id with several
    texts, each text. Rows of those beyond the sample are left out in the order of hashes of id and text. Without
    ratings or documents all weights are 0 and all grades equally likely. Texts of any length are read whole.
    """
    rated = ratings.select("doc_id", F.col("grade").cast("int").alias("grade"))
    rated = rated.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    # At most ``sample`` rows of two numbers are sent to the executors.
    examples = texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "grade", F.xxhash64("text").alias("text_hash"),
        F.pandas_udf(hashed_sets, "array<int>")("text").alias("features"),
    )
    in_order = [F.xxhash64("doc_id"), "doc_id", "text_hash", "grade"]

    def fit_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for batch in batches for r in zip(batch["doc_id"], batch["grade"], batch["features"])]
        rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        model = learn([r[2] for r in rows], np.array([r[1] for r in rows], dtype=int), grades)
        numbers = [*model.weights.items(), *((-1 - k, x) for k, x in enumerate(model.thresholds.tolist()))]
        yield pd.DataFrame(numbers, columns=["key", "value"])

    # The limit leaves one task, which has at most ``sample`` rows.
    numbers = dict(map(tuple, examples.orderBy(*in_order).limit(sample).mapInPandas(fit_all, "key long, value double").collect()))
    if not numbers:
        return learn([], np.zeros(0, dtype=int), grades)
    thresholds = [numbers.pop(-1 - k) for k in range(grades - 1)]
    return OrdinalModel(numbers, np.array(thresholds))


def hashed_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted({hashed(t) for t in tokens_of(text)}) for text in texts], dtype=object)


def learn(
    features: list[np.ndarray],
    grades: np.ndarray,
    n_grades: int,
    passes: int = 20,
    batch: int = 64,
    step: float = 1.0,
    l1: float = 20.0,
    l2: float = 0.01,
    only_against: bool = True,
) -> OrdinalModel:
    """Follow the regularised leader (per-coordinate steps, L1 for few weights) over shuffled batches.

    With ``only_against`` no weight is above 0: a token can tell against a text, and a text without such tokens has
    the best score, so that length earns nothing. Features of fewer than one in a thousand examples get no weight: in
    long texts the noise of many such would hide the few words that tell.
    """
    found = np.zeros(DIMENSIONS, dtype=np.int64)
    for own in features:  # a set each
        found[own] += 1
    common = found >= max(2, len(features) // 1000)
    features = [f[common[f]] for f in features]
    shares = (np.bincount(grades, minlength=n_grades) + 1) / (len(grades) + n_grades)
    below = np.cumsum(shares)[:-1]
    thresholds = np.log(below / (1 - below))
    weights, sums, squares = (np.zeros(DIMENSIONS) for _ in range(3))
    order = np.random.default_rng(7)
    for _ in range(passes if len(features) else 0):
        for rows in np.array_split(order.permutation(len(features)), max(1, len(features) // batch)):
            lengths = [len(features[i]) for i in rows]
            flat = np.concatenate([features[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), lengths)
            scores = np.bincount(owner, weights[flat], len(rows))
            edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
            upper = logistic(edges[grades[rows] + 1] - scores)
            lower = logistic(edges[grades[rows]] - scores)
            slope = 1 - upper - lower  # of the loss by the score
            used, where = np.unique(flat, return_inverse=True)
            gradient = np.bincount(where, slope[owner], len(used))
            grown = squares[used] + gradient**2
            sums[used] += gradient - (np.sqrt(grown) - np.sqrt(squares[used])) / step * weights[used]
            squares[used] = grown
            shrunk = np.sign(sums[used]) * np.maximum(np.abs(sums[used]) - l1, 0)
            weights[used] = -shrunk / ((1 + np.sqrt(grown)) / step + l2)
            if only_against:
                weights[used] = np.minimum(weights[used], 0)
            thresholds = move(thresholds, grades[rows], upper, lower)
    used = np.flatnonzero(weights)
    return OrdinalModel(dict(zip(used.tolist(), weights[used].tolist())), thresholds)


def move(thresholds: np.ndarray, grades: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """A small step of the thresholds up the likelihood; they stay in order."""
    share = np.maximum(upper - lower, 1e-6)
    gradient = np.bincount(grades, upper * (1 - upper) / share, len(thresholds) + 1)[:-1]
    gradient -= np.bincount(grades, lower * (1 - lower) / share, len(thresholds) + 1)[1:]
    moved = thresholds + 0.02 * np.clip(gradient, -5, 5)
    return np.maximum.accumulate(moved + 1e-3 * np.arange(len(moved)))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grades of the labelled table: 0 poor text, 1 good but toxic, 2 good and clean."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when((quality == 1) & (toxic == 0), 2)
