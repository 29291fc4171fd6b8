"""Descriptions for rows that lack one: derivation from related codes, back-fill from dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.functions.text import usable

# An attempt form, and the ways in which a code can lose its ending, tried in this order.
ATTEMPT = r"^664/(.+)$"
ENDINGS = (r"\([A-Z0-9]+\)$", r"[A-Z]+$", r"\..*$", r"\s+(MPOL|VC|PC)/?.*$")


def candidates(code):
    """array<struct<code, prefix>>: the dictionary codes to try, best first."""
    code = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    target = F.regexp_extract(code, ATTEMPT, 1)
    first = F.array(F.struct(target.alias("code"), F.lit("ATT:").alias("prefix")))
    rest = [F.struct(F.trim(F.regexp_replace(code, e, "")).alias("code"), F.lit("").alias("prefix")) for e in ENDINGS]
    changed = F.filter(F.array(*rest), lambda x: (x["code"] != "") & (x["code"] != code))
    return F.concat(F.filter(first, lambda x: x["code"] != ""), changed)


def derive(df: DataFrame, dictionary: DataFrame, id_col: str, code_col: str) -> DataFrame:
    """(id, derived_desc): the first candidate that the dictionary (dict_code, dict_desc) holds; '' if none."""
    tried = df.select(F.col(id_col).alias("__id"), F.posexplode(candidates(F.col(code_col))).alias("at", "c"))
    hits = tried.join(dictionary, tried["c.code"] == dictionary["dict_code"])
    best = hits.groupBy("__id").agg(F.min_by(F.concat("c.prefix", "dict_desc"), "at").alias("__derived"))
    found = df.select(F.col(id_col).alias("__key")).join(best, F.col("__key") == F.col("__id"), "left")
    return found.select(F.col("__key").alias(id_col), F.coalesce("__derived", F.lit("")).alias("derived_desc"))


def backfill(df: DataFrame, newest: DataFrame, all_years: DataFrame, code_col: str = "chrg_code", desc_col: str = "chrg_desc") -> DataFrame:
    """Short descriptions replaced by the newest dictionary's, else the all-years one's, else ''."""
    a = newest.select(F.col("dict_code").alias("__a"), F.col("dict_desc").alias("__newest"))
    b = all_years.select(F.col("dict_code").alias("__b"), F.col("dict_desc").alias("__all"))
    joined = df.join(a, F.col(code_col) == F.col("__a"), "left").join(b, F.col(code_col) == F.col("__b"), "left")
    known = F.coalesce(F.nullif("__newest", F.lit("")), F.nullif("__all", F.lit("")), F.lit(""))
    desc = F.when(usable(F.col(desc_col)), F.col(desc_col)).otherwise(known)
    return joined.withColumn(desc_col, desc).select(*df.columns)
