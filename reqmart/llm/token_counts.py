"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic programming keeps, per
character, only the best score of a segmentation up to there and its number of pieces. The rules are those of the
public unigram model: of equal scores the segmentation whose last piece is longest stays, a character that is no piece
itself scores ten less than the worst piece, and counts as its bytes. Blanks become the mark that begins a word; no
piece crosses such a mark or a line feed, so the parts between are counted one by one, and once each while a worker
remembers them.

The vocabulary and its scores are those of a public tokenizer file, taken as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Parts whose count a worker remembers; beyond it starts anew. Bounds memory only.
KEPT_PARTS = 400_000


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PartCounts(dict):
    """Number of pieces of each part that is looked up."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if "\n" in piece or MARK in piece[1:].lstrip(MARK):
                raise ValueError(f"parts can't be counted one by one with the piece {piece!r}")
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def __missing__(self, part: str) -> int:
        count = self[part] = self.count(part)
        return count

    def count(self, part: str) -> int:
        """Pieces of the best segmentation."""
        scores, counts = [0.0], [0]
        matches = self.automaton.iter(part)
        end, match = next(matches, (-1, None))
        for i, character in enumerate(part):
            best, pieces, alone = None, 0, False
            # Longest first, so that a later match has to be better.
            while end == i:
                length, score = match
                candidate = scores[i + 1 - length] + score
                if best is None or candidate > best:
                    best, pieces = candidate, counts[i + 1 - length] + 1
                alone = alone or length == 1
                end, match = next(matches, (-1, None))
            if not alone:
                candidate = scores[i] + self.unknown
                if best is None or candidate > best:
                    best, pieces = candidate, counts[i] + len(character.encode("utf-8", "surrogatepass"))
            scores.append(best)
            counts.append(pieces)
        return counts[-1]

    def of_text(self, text: str) -> int:
        if not text:
            return 0
        if len(self) > KEPT_PARTS:
            self.clear()
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        lines = marked.count("\n")  # a line feed is no piece: it counts as one byte
        return lines + sum(map(self.__getitem__, marked.replace(MARK, "\n" + MARK).split("\n")))


def worker_counts(model_path: str) -> PartCounts:
    """The counts of this worker process, which serves many tasks. They are kept with the automaton's module, because
    functions that travel by value get new globals in each task."""
    import ahocorasick

    kept = vars(ahocorasick).setdefault("_part_counts", {})
    if model_path not in kept:
        kept[model_path] = PartCounts(vocabulary(model_path))
    return kept[model_path]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and n_tokens per document, from doc_id and text; no other column is read.

    Null and empty texts have no tokens. Repeated rows are counted alike; null ids stay null.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = worker_counts(model_path)
        for texts in batches:
            yield pd.Series([counts.of_text(t or "") for t in texts], dtype="int64")

    return docs.select("doc_id", F.pandas_udf(count, "long")("text").alias("n_tokens"))
