"""Similarity of column names.  Names are metadata: there are few, and they are compared in the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from difflib import SequenceMatcher
from functools import lru_cache
from math import sqrt

from ..config import KEY_COLUMN_WORDS

Vectors = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def normal(name: str | None) -> str:
    return (name or "").strip().lower()


@lru_cache(maxsize=100_000)
def _ratio(a: str, b: str) -> float:
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def similarity(a: str | None, b: str | None) -> float:
    """Matching-blocks ratio of the lower-cased names; it depends on their order."""
    return _ratio(normal(a), normal(b))


def cosine(x: Sequence[float], y: Sequence[float]) -> float:
    """0.0 where a vector has no length."""
    nx, ny = sqrt(sum(v * v for v in x)), sqrt(sum(v * v for v in y))
    return sum(v * w for v, w in zip(x, y, strict=True)) / (nx * ny) if nx and ny else 0.0


class VectorSimilarity:
    """Cosine of vectors from a provider; equal names are 1.0.  Vectors of names are kept."""

    def __init__(self, vectors: Vectors):
        self.vectors, self.known = vectors, {}

    def __call__(self, a: str | None, b: str | None) -> float:
        a, b = normal(a), normal(b)
        if a == b:
            return 1.0
        if new := [n for n in dict.fromkeys((a, b)) if n not in self.known]:
            self.known.update(zip(new, self.vectors(new), strict=True))
        return cosine(self.known[a], self.known[b])


def mean_similarity(a: Sequence[str], b: Sequence[str], by: Callable[[str, str], float] = similarity) -> float:
    """Average over paired columns; 0 if the lengths differ."""
    return sum(map(by, a, b)) / len(a) if a and len(a) == len(b) else 0.0


def is_potential_key(name: str) -> bool:
    return any(w in normal(name) for w in KEY_COLUMN_WORDS)
