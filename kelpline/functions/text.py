"""Scalar column functions: normalisation, coercion, n-grams, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as missing, in upper case.
MISSING = ("", "NAN", "NA", "N/A", "NULL", "NONE")
# White space as Python's str.strip and \s see it.
_WS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def bare(x: Column) -> Column:
    """Null as empty; outer white space of any kind removed."""
    return F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), f"^{_WS}|{_WS}$", "")


def normalize_code(x: Column) -> Column:
    up = F.upper(bare(x))
    return F.when(up.isin(*MISSING), F.lit("")).otherwise(up)


def normalize_description(x: Column, lower: bool = False) -> Column:
    up = normalize_code(x)
    return F.lower(up) if lower else up


def squeeze(x: Column) -> Column:
    """Null as empty; runs of white space as one space; case kept."""
    return bare(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), _WS, " "))


def search_text(x: Column) -> Column:
    return F.upper(squeeze(x))


def strip_code(x: Column) -> Column:
    """ASCII letters and digits only, in capitals; null as empty."""
    return F.upper(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), "[^A-Za-z0-9]", ""))


def number(x: Column) -> Column:
    """Coercion: what is no number is null."""
    return x.cast("string").try_cast("double")


def flag(x: Column) -> Column:
    return number(x).try_cast("int")


def is_new(charge_key: Column) -> Column:
    """Zero, absent or unreadable keys mark new rows."""
    return F.coalesce(number(charge_key), F.lit(0.0)) == 0


def usable(desc: Column) -> Column:
    return F.length(desc) >= 3


def route(code: Column, desc: Column) -> Column:
    """described, code_only, or dropped: what can be matched by description, by code alone, or not at all."""
    return F.when(usable(desc) & ~desc.endswith("-"), "described").when(code != "", "code_only").otherwise("dropped")


def sorted_tokens(x: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(x, _WS), lambda t: t != "")), " ")


def token_set(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(x, _WS), lambda t: t != "")))


def _windows(padded: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))


def char_ngrams(x: Column, low: int, high: int) -> Column:
    """Character n-grams of each word padded by a space on both sides.

    A padded word shorter than ``low`` gives itself; longer n than the word add nothing.
    """

    def grams(padded: Column) -> Column:
        none = F.array().cast("array<string>")
        longer = [F.when(F.length(padded) >= n, _windows(padded, n)).otherwise(none) for n in range(low + 1, high + 1)]
        return F.concat(_windows(padded, low), *longer)

    words = F.filter(F.split(x, _WS), lambda w: w != "")
    return F.flatten(F.transform(words, lambda w: grams(F.concat(F.lit(" "), w, F.lit(" ")))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(v: Column) -> Column:
    """Scaled to norm 1; a zero vector stays."""

    def scaled(norm: Column) -> Column:
        return F.transform(v, lambda x: x.cast("double") / F.when(norm == 0, F.lit(1.0)).otherwise(norm))

    return F.transform(F.array(F.sqrt(dot(v, v))), scaled)[0]


def weighted(parts: list[tuple[float, Column]]) -> Column:
    """Weighted mean; null-safe where all weights are zero."""
    total = sum(w for w, _ in parts)
    value = parts[0][1] * parts[0][0]
    for w, c in parts[1:]:
        value = value + c * w
    return F.try_divide(value, F.lit(float(total)))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def staged(df: DataFrame) -> DataFrame:
    """The same rows; keeps the optimizer from copying a costly column into each of its uses."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]))))
