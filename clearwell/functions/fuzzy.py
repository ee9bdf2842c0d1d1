"""Similarity of strings, 0 to 100: indel ratio, token sets and a weighted blend, by their textbook definitions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def common(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bits."""
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    whole = row = (1 << len(a)) - 1
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & whole
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, one, two = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not one or not two):
        return 100.0
    one, two = f"{both} {one}".strip(), f"{both} {two}".strip()
    return max([ratio(one, two), *([ratio(both, one), ratio(both, two)] if both else [])])


def partial(f, a: str, b: str) -> float:
    """The best of f over the stretches of the longer string that are as long as the shorter."""
    if len(a) > len(b):
        a, b = b, a
    return max((f(a, b[i : i + len(a)]) for i in range(len(b) - len(a) + 1)), default=0.0) if a else 0.0


def partial_tokens(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    return partial(ratio, " ".join(sorted(x)), " ".join(sorted(y)))


@lru_cache(200_000)
def weighted(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    if stretch < 1.5:
        return max(ratio(a, b), 0.95 * max(sort_ratio(a, b), set_ratio(a, b)))
    scale = 0.9 if stretch <= 8 else 0.6
    return max(ratio(a, b), scale * partial(ratio, a, b), 0.95 * scale * max(partial_tokens(a, b), partial(ratio, " ".join(sorted(a.split())), " ".join(sorted(b.split())))))


def _column(f):
    @F.pandas_udf(DoubleType())
    def score(a, b):
        return a.combine(b, lambda x, y: None if x is None or y is None else f(x, y))

    return score


set_score, weighted_score = _column(set_ratio), _column(weighted)
