"""Keyed first and last rows, unions by name, code dictionaries.

Nothing relies on the order of a DataFrame: ``order`` columns are explicit.
Choices by key are aggregates of structs (max_by, min_by), which combine before
they shuffle, rather than windows over whole groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.functions.text import number, usable


def _pick(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(rest)])
    chosen = df.groupBy(*keys).agg(pick(row, F.struct(*order)).alias("__row"))
    named = {c: F.col("__row")[f"_{k}"].alias(c) for k, c in enumerate(rest)}
    return chosen.select(*[named.get(c, F.col(f"`{c}`")) for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _pick(df, keys, [F.col(c) for c in order], F.min_by)


def keep_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _pick(df, keys, [F.col(c) for c in order], F.max_by)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Columns in the order first seen, absent ones null; ``load_seq`` keeps the order of the frames."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reference(frames: DataFrame, code: str = "chrg_code", desc: str = "chrg_desc", year: str = "source_year", seq: str = "load_seq") -> DataFrame:
    """The catalogue: last row per (code, desc) by year then load order, usable descriptions, ``ref_pos`` from 0."""
    last = keep_last(frames, [code, desc], year, seq).where(usable(F.col(desc)))
    return with_position(last, "ref_pos", year, seq)


def with_position(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Dense positions 0.. in the given order without sorting all rows in one task.

    Rows are range-partitioned and ranked in their partition; each partition's offset is a sum of counts.
    """
    spark = df.sparkSession
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    parts = parts.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(*order)))
    parts = parts.persist()
    counts = dict(parts.groupBy("__p").count().collect())
    total, starts = 0, []
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    offsets = spark.createDataFrame(starts, "__p int, __start long")
    out = parts.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__start") + F.col("__r") - 1)
    return out.drop("__p", "__r", "__start")


def finalized(frames: DataFrame, code: str = "chrg_code", desc: str = "chrg_desc", seq: str = "load_seq") -> DataFrame:
    """Last row per (code, desc) by load order alone."""
    return keep_last(frames, [code, desc], seq).where(usable(F.col(desc)))


def latest_descriptions(df: DataFrame, code: str = "chrg_code", desc: str = "chrg_desc", year: str = "source_year", seq: str = "load_seq") -> DataFrame:
    """(code, desc): the newest description of each code that is not blank."""
    return (
        df.where(F.col(code) != "")
        .groupBy(F.col(code).alias("dict_code"))
        .agg(F.max_by(desc, F.struct(year, seq)).alias("dict_desc"))
    )


def append_key(current: DataFrame, added: DataFrame, keys: list[str], seq: str = "load_seq") -> DataFrame:
    """Existing rows win over added ones; among equals the earlier."""
    both = union_by_name(current.withColumn("__new", F.lit(0)), added.withColumn("__new", F.lit(1)))
    return keep_first(both, keys, "__new", seq).drop("__new")


def code_groups(df: DataFrame, attrs: list[str], code: str = "chrg_code", year: str = "source_year", pos: str = "ref_pos") -> DataFrame:
    """Per non-blank code: its newest row, and whether any attribute takes more than one value (null is a value)."""
    differs = F.lit(False)
    for a in attrs:
        c = F.col(f"`{a}`")
        differs = differs | ((F.count_distinct(c) + F.max(c.isNull().cast("int"))) > 1)
    rest = [c for c in df.columns if c != code]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    grouped = df.where(F.col(code) != "").groupBy(code).agg(F.max_by(row, F.struct(year, pos)).alias("__row"), differs.alias("conflict"))
    return grouped.select(code, "__row.*", "conflict")


def year_number(x: Column) -> Column:
    return number(x).cast("int")
