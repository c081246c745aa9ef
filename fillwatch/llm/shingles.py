"""Sets of word shingles, their signatures, and links inside a cell of documents (array code)."""

from __future__ import annotations

import hashlib

import numpy as np

from fillwatch.llm.texts import U, Hasher, byte_words, mix

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=U) * U(2) + U(1)


def sets_of(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z is lower-cased.

    A shingle is ``width`` words in a row. A text of fewer words is one shingle; a text without
    words has none.
    """
    data = _LOWER[data]
    start, end, first = byte_words(data, at)
    word = Hasher(data).spans(start, end)
    factor = _odd(width, 11)
    total = np.zeros(max(0, len(word) - width + 1), U)
    for j in range(width):
        total += word[j : j + len(total)] * factor[j]
    shingle = mix(total)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        n = high - low
        if n >= width:
            out.append(np.unique(shingle[low : high - width + 1]))
        elif n:
            missing = np.full(1, width - n, U) * U(0xA0761D6478BD642F)
            out.append(mix(missing + (word[low:high] * factor[:n]).sum(dtype=U)))
        else:
            out.append(np.zeros(0, U))
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray, factors: np.ndarray, columns: int = 2048) -> np.ndarray:
    """The least hash under each factor (32 bits each)."""
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(shingles), columns):
        part = (shingles[None, low : low + columns] * factors[:, None]) >> U(32)
        np.minimum(least, part.min(axis=1).astype(np.uint32), out=least)
    return least


def factors(coordinates: int, seed: int = 7) -> np.ndarray:
    return _odd(coordinates, seed)


class Forest:
    """Components of the members of one cell."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, member: int, linked: np.ndarray) -> None:
        touched = np.unique(np.append(self.of[linked], self.of[member]))
        if len(touched) > 1:
            self.of[np.isin(self.of, touched)] = touched[0]


def grow(n: int, linked_to, probes: int = 4) -> Forest:
    """Components of ``n`` members, exact, without looking at all pairs.

    ``linked_to(i)`` gives the members linked to i. Once the component of a few probes is known,
    only members outside of it are looked at: a link that matters has an end outside of it. So a
    group of copies costs about one look at each member, and nothing is skipped.
    """
    forest = Forest(n)
    if n < 2:
        return forest
    for i in dict.fromkeys(int(n * k / probes) for k in range(probes)):
        forest.join(i, linked_to(i))
    core = np.bincount(forest.of).argmax()
    for i in range(n):
        if forest.of[i] != forest.of[core]:
            forest.join(i, linked_to(i))
    return forest


def cell_links(shingles: list[np.ndarray], part: int, whole: int) -> Forest:
    """Components of texts with part/whole of their shingles in common, on full sets."""
    size = np.array([len(s) for s in shingles])
    start = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=start[1:])
    known, code = np.unique(np.concatenate(shingles), return_inverse=True)
    mark = np.zeros(len(known), bool)

    def linked_to(i: int) -> np.ndarray:
        mark[code[start[i] : start[i + 1]]] = True
        common = np.add.reduceat(mark[code], start[:-1], dtype=np.int64)
        mark[code[start[i] : start[i + 1]]] = False
        return np.flatnonzero(whole * common >= part * (size + size[i] - common))

    return grow(len(size), linked_to)


def alike(signatures: np.ndarray, least: int) -> Forest:
    """Components of the rows of a signature matrix that agree in ``least`` places or more."""

    def linked_to(i: int) -> np.ndarray:
        return np.flatnonzero((signatures == signatures[i]).sum(axis=1) >= least)

    return grow(len(signatures), linked_to)
