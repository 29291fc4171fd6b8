"""Column expressions over texts that several native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that parts words: space and the ASCII controls from tab to return.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def barrier(df: DataFrame) -> DataFrame:
    """The same rows; keeps the optimizer from copying a costly column into each of its uses."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]))))


def words(text: Column) -> Column:
    """Words of a text, never null; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
