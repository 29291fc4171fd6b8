"""SQL expressions (DuckDB) that mirror the text functions, for the oracles."""

from __future__ import annotations

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"


def bare(x: str) -> str:
    return f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '^{WS}|{WS}$', '', 'g')"


def code(x: str) -> str:
    up = f"upper({bare(x)})"
    return f"CASE WHEN {up} IN ('', 'NAN', 'NA', 'N/A', 'NULL', 'NONE') THEN '' ELSE {up} END"


def squeeze(x: str) -> str:
    return bare(f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '{WS}', ' ', 'g')")


def strip(x: str) -> str:
    return f"upper(regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '[^A-Za-z0-9]', '', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}'), lambda t: t <> '')"


def sorted_tokens(x: str) -> str:
    return f"array_to_string(list_sort({tokens(x)}), ' ')"


def lcs(a: str, b: str) -> str:
    """Bit-parallel common subsequence length; texts of at most 61 characters."""
    full = f"((CAST(1 AS BIGINT) << CAST(length({a}) AS INT)) - 1)"
    mask = f"coalesce(list_aggregate(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, CAST(i + 1 AS INT), 1) = c THEN CAST(1 AS BIGINT) << CAST(i AS INT) ELSE 0 END), 'bit_or'), 0)"
    masks = f"list_transform(string_split({b}, ''), lambda c: {mask})"
    last = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"(length({a}) - bit_count({last}))"


def ratio(common: str, a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 ELSE 200.0 * ({common}) / (length({a}) + length({b})) END"


def token_set_columns(a: str, b: str) -> str:
    """Columns sh, ra, rb (shared words, rests) of two text columns."""
    ta, tb = f"list_sort(list_distinct({tokens(a)}))", f"list_sort(list_distinct({tokens(b)}))"
    return (
        f"len({ta}) AS na, len({tb}) AS nb, array_to_string(list_filter({ta}, lambda t: list_contains({tb}, t)), ' ') AS sh, "
        f"array_to_string(list_filter({ta}, lambda t: NOT list_contains({tb}, t)), ' ') AS ra, array_to_string(list_filter({tb}, lambda t: NOT list_contains({ta}, t)), ' ') AS rb"
    )


def token_set(common: str = "cset") -> str:
    """Ratio from the columns of token_set_columns and the common length of ra and rb."""
    s, x, y = "length(sh)", "length(ra)", "length(rb)"
    g = "(CASE WHEN length(sh) > 0 THEN 1 ELSE 0 END)"
    side = lambda z: f"CASE WHEN {s} > 0 THEN 100.0 - 100.0 * ({g} + {z}) / (2 * {s} + {g} + {z}) ELSE 0 END"
    return (
        f"CASE WHEN na = 0 OR nb = 0 THEN 0.0 WHEN {s} > 0 AND ({x} = 0 OR {y} = 0) THEN 100.0 ELSE "
        f"greatest(100.0 - 100.0 * ({x} + {y} - 2 * {common}) / (2 * {s} + 2 * {g} + {x} + {y}), {side(x)}, {side(y)}) END"
    )


def ngrams(w: str, low: int, high: int) -> str:
    """N-grams of one padded word."""
    parts = [f"list_transform(range(greatest(length({w}) - {n} + 1, 1)), lambda i: substr({w}, CAST(i + 1 AS INT), {n}))" for n in range(low, high + 1)]
    out = parts[0]
    for n, p in zip(range(low + 1, high + 1), parts[1:], strict=True):
        out = f"list_concat({out}, CASE WHEN length({w}) >= {n} THEN {p} ELSE [] END)"
    return out
