"""Result tables of both flows, their Parquet and workbook sinks, run summaries."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline import contracts
from kelpline.operators.dedupe import append_key, keep_first
from kelpline.sources.xlsx import write_workbook

INPUT = ["input_chrg_code", "input_chrg_desc"]


def primary_tables(results: DataFrame, key: DataFrame | None, site: str, attrs: list[str]) -> dict[str, DataFrame]:
    """key, added and review. Accepted rows join the key, where existing rows win.

    ``results`` has result_seq, the order in which first rows are kept.
    """
    out = results.withColumnRenamed("similarity_score", "simiarity_score").withColumn("site", F.lit(site))
    if "filled_from_existing_ck" not in out.columns:
        out = out.withColumn("filled_from_existing_ck", F.lit(False))
    added = keep_first(out.where(~F.col("needs_human_review")), INPUT, "result_seq")
    review = keep_first(out.where(F.col("needs_human_review")), INPUT, "result_seq")
    columns = [*contracts.KEY_COLUMNS, *attrs]
    fresh = added.withColumnsRenamed({"input_chrg_code": "chrg_code", "input_chrg_desc": "chrg_desc"})
    fresh = contracts.conform(fresh, [*columns, "result_seq"])
    fresh = fresh.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], F.col("result_seq").alias("load_seq"))
    if key is None:
        merged = keep_first(fresh, ["chrg_code", "chrg_desc"], "load_seq")
    else:
        old = key.withColumn("site", F.lit(site))
        seq = F.col("load_seq") if "load_seq" in key.columns else F.monotonically_increasing_id()
        old = contracts.conform(old.withColumn("load_seq", seq), [*columns, "load_seq"])
        merged = append_key(old.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], "load_seq"), fresh, ["chrg_code", "chrg_desc"])
    match = [*contracts.MATCH_COLUMNS, *attrs]
    return {"Charge Key": merged.select(*columns), "Charges added": contracts.conform(added, match), "Charge to be Reviewed": contracts.conform(review, match)}


def secondary_tables(results: DataFrame) -> dict[str, DataFrame]:
    """confident (no disagreement), ensemble_resolved (all settled), needs_review."""
    review, some = F.col("needs_human_review"), F.col("disagreement_count") > 0
    return {"confident": results.where(~review & ~some), "ensemble_resolved": results.where(~review & some), "needs_review": results.where(review)}


def write_parquet(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table per name; the sink for results of any size."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name.replace(' ', '_').lower()}")


def write_xlsx(tables: dict[str, DataFrame], path: str | Path) -> Path:
    """A workbook of at most 1,048,575 rows a sheet, streamed row by row through the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    write_workbook(str(path), {name: (df.columns, (tuple(r) for r in df.toLocalIterator())) for name, df in tables.items()})
    return Path(path)


def primary_path(output: str | Path, site: str, year: str) -> Path:
    return Path(output) / f"{site}_charge_key_intermediary_{year}.xlsx"


def secondary_path(output: str | Path, site: str, year: str) -> Path:
    return Path(output) / f"{site}_court_{year}_matches_noLLM.xlsx"


def rate(total, review):
    """Share of rows without review in percent, one decimal; 0 without rows."""
    return F.coalesce(F.round(F.try_divide((total - review) * F.lit(100.0), total), 1), F.lit(0.0))


def primary_summary(results: DataFrame) -> DataFrame:
    total, review = F.count("*"), F.count_if("needs_human_review")
    return results.agg(total.alias("total"), (total - review).alias("auto_classified"), review.alias("needs_review"), rate(total, review).alias("automation_rate"))


def secondary_summary(results: DataFrame) -> DataFrame:
    review, some = F.col("needs_human_review"), F.col("disagreement_count") > 0
    total, reviews = F.count("*"), F.count_if(review)
    return results.agg(
        total.alias("total"), F.count_if(~review & ~some).alias("confident"), F.count_if(~review & some).alias("ensemble_resolved"),
        reviews.alias("needs_review"), rate(total, reviews).alias("automation_rate"),
    )
