"""File discovery, CSV and workbook scans, multi-year scans and fallback chains of keys."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import rules
from kelpline.contracts import require
from kelpline.functions.text import normalize_code, normalize_description
from kelpline.sources.xlsx import read_xlsx

NEEDED, NEEDED_NEW = ("chrg_code", "chrg_desc"), ("chrg_code", "chrg_desc", "charge_key")


def find_files(folder: str | Path, site: str) -> list[Path]:
    """A site's .csv and .xlsx files right in the folder, by name; none if there is no folder."""
    folder = Path(folder)
    if not folder.is_dir():
        return []
    begins = rules.aliases(site)
    return sorted(p for p in folder.iterdir() if p.suffix.lower() in (".csv", ".xlsx") and p.name.startswith(begins))


def read_csv(spark: SparkSession, path: str | Path) -> DataFrame:
    """All columns as strings. UTF-8; a file that is not valid UTF-8 is read as Windows-1252."""
    where = str(path)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    plain = reader.csv(where)
    broken = reduce(lambda a, b: a | b, [F.col(f"`{c}`").contains("�") for c in plain.columns], F.lit(False))
    if any("�" in c for c in plain.columns) or not plain.where(broken).isEmpty():
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        return reader.option("encoding", "windows-1252").csv(where)
    return plain


def tidy_columns(df: DataFrame) -> DataFrame:
    """Historical spellings renamed, helper columns dropped."""
    return df.withColumnsRenamed(rules.RENAMES).drop(*[c for c in rules.DROPPED if c in df.columns])


def read_table(spark: SparkSession, path: str | Path, sheet: str | int = 0) -> DataFrame:
    raw = read_xlsx(spark, str(path), sheet) if Path(path).suffix.lower() == ".xlsx" else read_csv(spark, path)
    return tidy_columns(raw)


def preprocess(df: DataFrame, site: str, source: str = "input") -> DataFrame:
    """Required columns checked, codes and descriptions normalised, the site's rules applied; adds load_seq."""
    require(df.columns, NEEDED, source)
    rule = rules.rule_for(site)
    if "load_seq" not in df.columns:
        df = df.withColumn("load_seq", F.monotonically_increasing_id())
    out = df.withColumns({"chrg_code": normalize_code(F.col("chrg_code")), "chrg_desc": normalize_description(F.col("chrg_desc"), rule.lower_descriptions)})
    return out.where("chrg_code <> ''") if rule.drop_blank_codes else out


def history(spark: SparkSession, data: str | Path, site: str, years: tuple[str, ...]) -> DataFrame | None:
    """All files of the years' key folders, raw, with source_year and load_seq; None if there is none."""
    frames = []
    for year in years:
        for path in find_files(Path(data) / f"{year}_c", site):
            df = read_table(spark, path)
            require(df.columns, NEEDED, str(path))
            seq = F.lit(len(frames)).cast("long") * (1 << 40) + F.monotonically_increasing_id()
            frames.append(df.withColumns({"source_year": F.lit(str(year)), "load_seq": seq}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def intermediary(output: str | Path, site: str, year: str) -> Path:
    return Path(output) / f"{site}_charge_key_intermediary_{year}.xlsx"


def current_key(spark: SparkSession, data: str | Path, output: str | Path, site: str, target: str, previous: str) -> DataFrame | None:
    """The target year's key, else the previous year's intermediary, else the previous year's key."""
    now = find_files(Path(data) / f"{target}_c", site)
    if now:
        return preprocess(read_table(spark, now[0]), site)
    made = intermediary(output, site, previous)
    if made.exists():
        return preprocess(read_table(spark, made, "Charge Key"), site)
    before = find_files(Path(data) / f"{previous}_c", site)
    return preprocess(read_table(spark, before[0]), site) if before else None


def finalized_key(spark: SparkSession, data: str | Path, output: str | Path, site: str, target: str) -> DataFrame:
    made = intermediary(output, site, target)
    if made.exists():
        return preprocess(read_table(spark, made, "Charge Key"), site)
    raw = find_files(Path(data) / f"{target}_c", site)
    if not raw:
        raise FileNotFoundError(f"no finalized key of {site} for {target}")
    return preprocess(read_table(spark, raw[0]), site)


def _diagnostic(spark: SparkSession, folder: Path, site: str) -> DataFrame:
    found = find_files(folder, site)
    if not found:
        raise FileNotFoundError(f"no diagnostic of {site} in {folder.name}")
    df = read_table(spark, found[0], "Sheet1")
    require(df.columns, NEEDED_NEW, str(found[0]))
    return preprocess(df, site)


def primary_diagnostic(spark: SparkSession, data: str | Path, site: str, target: str) -> DataFrame:
    return _diagnostic(spark, Path(data) / f"{target}_d", site)


def secondary_diagnostic(spark: SparkSession, data: str | Path, site: str, target: str) -> DataFrame:
    return _diagnostic(spark, Path(data) / f"{target}_court_d", site)
