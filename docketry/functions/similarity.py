"""String and date similarities."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by dynamic programming over array rows; 0 where either is empty."""

    def next_row(prev: Column, i: Column) -> Column:
        cell = lambda cur, j: F.concat(cur, F.array(F.when(F.substring(a, i, F.lit(1)) == F.substring(b, j, F.lit(1)), F.get(prev, j - 1) + 1).otherwise(F.greatest(F.get(prev, j), F.element_at(cur, -1)))))
        return F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), cell)

    table = F.aggregate(F.sequence(F.lit(1), F.length(a)), F.array_repeat(F.lit(0), F.length(b) + 1), next_row)
    return F.when((F.length(a) > 0) & (F.length(b) > 0), F.element_at(table, -1)).otherwise(F.lit(0))


def indel_ratio(a: Column, b: Column) -> Column:
    """100 for equal texts, else 200 times the common subsequence over both lengths; two empty texts are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs_length(a, b) / total)


def lcs_of(a: str, b: str) -> int:
    """Longest common subsequence by bit vectors: one integer operation per letter of ``b``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio_of(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs_of(a, b) / (len(a) + len(b))


@functools.lru_cache(maxsize=500_000)
def token_set_ratio_of(a: str, b: str) -> float:
    """Best indel ratio among the shared words and either side's shared words with its rest; 0 where either is empty."""
    wa, wb = set(a.split()), set(b.split())
    if not wa or not wb:
        return 0.0
    both, left, right = wa & wb, wa - wb, wb - wa
    if both and (not left or not right):
        return 100.0
    text = lambda *parts: " ".join(w for p in parts for w in sorted(p))
    x, y = text(both, left), text(both, right)
    best = ratio_of(x, y)
    return max(best, ratio_of(text(both), x), ratio_of(text(both), y)) if both else best


def token_set_ratio(a: Column, b: Column) -> Column:
    """``token_set_ratio_of`` by Arrow batches; null where either side is null."""

    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else token_set_ratio_of(p, q) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(score, "double")(a, b)


@functools.lru_cache(maxsize=500_000)
def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro-Winkler similarity: prefix of at most four letters, weight 0.1, boost above 0.7 only. Equal texts give 1."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(0, max(la, lb) // 2 - 1)
    used = [False] * lb
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [b[j] for j in range(lb) if used[j]]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / la + m / lb + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, la, lb) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def jaro_winkler(a: Column, b: Column) -> Column:
    """``jaro_winkler_of`` by Arrow batches; null where either side is null."""

    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else jaro_winkler_of(p, q) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(score, "double")(a, b)


def dob_similarity(a: Column, b: Column) -> Column:
    """1 equal, 0.85 day and month exchanged, 0.6 one part differs, 0 else; 0.5 where either (yyyy-MM-dd) is unknown."""
    part = lambda c, at, n: F.substring(c, at, n)
    same = (part(a, 1, 4) == part(b, 1, 4)).cast("int") + (part(a, 6, 2) == part(b, 6, 2)).cast("int") + (part(a, 9, 2) == part(b, 9, 2)).cast("int")
    swapped = (part(a, 1, 4) == part(b, 1, 4)) & (part(a, 6, 2) == part(b, 9, 2)) & (part(a, 9, 2) == part(b, 6, 2))
    unknown = F.coalesce(a, F.lit("")).isin("", "nan") | F.coalesce(b, F.lit("")).isin("", "nan")
    return F.when(unknown, 0.5).when(a == b, 1.0).when(swapped, 0.85).when(same == 2, 0.6).otherwise(0.0)
