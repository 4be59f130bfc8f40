"""Words and shingles of many texts at a time, as numbers, in numpy."""

from __future__ import annotations

import numpy as np

#: Blank, tab, line feed, vertical tab, form feed and carriage return part words.
BLANKS = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one (the finaliser of a public hash function)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def numbers(n: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit numbers that look random."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


BYTE_VALUES = mix(numbers(256, 11))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A to Z in lower case, and the number of words of each text."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    blob = np.frombuffer(b"\n".join([*encoded, b""]).translate(LOWER), dtype=np.uint8)
    is_blank = np.zeros(256, dtype=bool)
    is_blank[list(BLANKS)] = True
    inside = np.concatenate([[False], ~is_blank[blob]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if inside[-1]:
        edges = np.append(edges, len(blob))
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(offsets, lengths)
    factors = numbers(int(lengths.max()), 37)
    values = BYTE_VALUES[blob[inside[1:]]] * factors[within]
    return mix(np.add.reduceat(values, offsets) + lengths.astype(np.uint64)), counts


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words; a shorter text is one shingle, an empty one none.
    """
    words, counts = word_hashes(texts)
    factors = numbers(size, 23)
    ends = np.cumsum(counts)
    if len(words) >= size:
        n = len(words) - size + 1
        shingles = mix(sum(words[j : j + n] * factors[j] for j in range(size)))
    sets = []
    for start, end in zip((ends - counts).tolist(), ends.tolist()):
        if end - start >= size:
            sets.append(np.unique(shingles[start : end - size + 1]))
        elif end > start:
            short = (words[start:end] * factors[: end - start]).sum(dtype=np.uint64)
            sets.append(mix(np.array([short + np.uint64(end - start)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
