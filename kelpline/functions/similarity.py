"""String similarity from one kernel: the length of the longest common subsequence.

``lcs`` is an Arrow UDF over bit-parallel integers; ``lcs_native`` is the same
recurrence as a Catalyst expression for texts of up to 62 characters. Ratios are
kept as integers until one last division, so thresholds are exact.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .text import sorted_tokens, token_set


def lcs_length(a: str, b: str) -> int:
    """Hyyro's bit-parallel recurrence; bits that become 0 are matched characters of ``a``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@F.pandas_udf(IntegerType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else lcs_length(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


def lcs_native(a: Column, b: Column) -> Column:
    one, n = F.lit(1).cast("long"), F.length(a)
    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

    def mask(c: Column) -> Column:
        return F.aggregate(at, F.lit(0).cast("long"), lambda m, i: F.when(F.substring(a, i + 1, F.lit(1)) == c, m.bitwiseOR(F.call_function("shiftleft", one, i))).otherwise(m))

    full = F.call_function("shiftleft", one, n) - 1
    masks = F.transform(F.filter(F.split(b, ""), lambda c: c != ""), mask)

    def step(v: Column, m: Column) -> Column:
        u = v.bitwiseAND(m)
        return (v + u).bitwiseOR(v - u).bitwiseAND(full)

    return F.when(n == 0, F.lit(0)).otherwise(n - F.bit_count(F.aggregate(masks, full, step)))


def indel_ratio(common: Column, a: Column, b: Column) -> Column:
    """0..100 from the common length; two empty texts are equal."""
    size = F.length(a) + F.length(b)
    return F.when(size == 0, F.lit(100.0)).otherwise(F.lit(200.0) * common / size)


def ratio(a: Column, b: Column, kernel=lcs) -> Column:
    return indel_ratio(kernel(a, b), a, b)


def token_sort_ratio(a: Column, b: Column, kernel=lcs) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b), kernel)


def token_set_ratio(a: Column, b: Column, kernel=lcs) -> Column:
    """Best of: rest against rest with the shared words in the lengths; shared words against each side."""
    ta, tb = token_set(a), token_set(b)
    joined = lambda x: F.array_join(x, " ")
    shared, ra, rb = joined(F.array_sort(F.array_intersect(ta, tb))), joined(F.array_except(ta, tb)), joined(F.array_except(tb, ta))
    s, x, y = F.length(shared), F.length(ra), F.length(rb)
    gap = (s > 0).cast("int")
    apart = x + y - 2 * kernel(ra, rb)
    rest = F.lit(100.0) - F.lit(100.0) * apart / (2 * s + 2 * gap + x + y)
    left = F.when(s > 0, F.lit(100.0) - F.lit(100.0) * (gap + x) / (2 * s + gap + x)).otherwise(F.lit(0.0))
    right = F.when(s > 0, F.lit(100.0) - F.lit(100.0) * (gap + y) / (2 * s + gap + y)).otherwise(F.lit(0.0))
    return (
        F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
        .when((s > 0) & ((x == 0) | (y == 0)), F.lit(100.0))
        .otherwise(F.greatest(rest, left, right))
    )
