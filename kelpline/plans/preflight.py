"""Checks before a run: what is missing, unreadable or suspicious in a site's inputs."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.config import PrimaryConfig, SecondaryConfig
from kelpline.contracts import modelled
from kelpline.functions.text import is_new
from kelpline.sources import files


class PreflightError(ValueError):
    pass


@dataclass(frozen=True)
class Issue:
    severity: str
    code: str
    message: str


@dataclass(frozen=True)
class Report:
    issues: tuple[Issue, ...]

    @property
    def errors(self) -> tuple[Issue, ...]:
        return tuple(i for i in self.issues if i.severity == "error")

    @property
    def warnings(self) -> tuple[Issue, ...]:
        return tuple(i for i in self.issues if i.severity == "warning")

    @property
    def ok(self) -> bool:
        return not self.errors

    def raise_for_errors(self) -> None:
        if self.errors:
            raise PreflightError("; ".join(f"{i.code}: {i.message}" for i in self.errors))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i.severity, i.code, i.message) for i in self.issues], "severity string, code string, message string")


class _Checks:
    def __init__(self, spark: SparkSession, site: str):
        self.spark, self.site, self.issues = spark, site, []

    def error(self, code: str, message: str) -> None:
        self.issues.append(Issue("error", code, message))

    def warn(self, code: str, message: str) -> None:
        self.issues.append(Issue("warning", code, message))

    def report(self) -> Report:
        return Report(tuple(self.issues))

    def configured(self, cfg) -> bool:
        try:
            cfg.validate()
        except ValueError as problem:
            self.error("invalid_config", str(problem))
            return False
        return True

    def folders(self, data: Path, output: Path) -> bool:
        if output.exists() and not output.is_dir():
            self.error("output_not_directory", f"{output} is no folder")
        if not data.is_dir():
            self.error("data_dir_missing", f"{data} does not exist")
            return False
        return True

    def read(self, path: Path, needed: tuple[str, ...], what: str, sheet: str | int = 0, unreadable: str = "file_unreadable") -> DataFrame | None:
        try:
            df = files.read_table(self.spark, path, sheet)
        except Exception as problem:  # any reader's failure is the finding
            self.error(unreadable, f"{what} {path.name}: {problem}")
            return None
        missing = [c for c in needed if c not in df.columns]
        if missing:
            self.error("missing_columns", f"{what} {path.name} lacks {', '.join(missing)}")
            return None
        return df

    def years(self, data: Path, years: tuple[str, ...], none: str, some: str) -> list[Path]:
        found = {y: files.find_files(data / f"{y}_c", self.site) for y in years}
        paths = [p for hits in found.values() for p in hits]
        gaps = [y for y, hits in found.items() if not hits]
        if not paths:
            self.error(none, f"{self.site} has no key of the years {', '.join(years)}")
        elif gaps:
            self.warn(some, f"{self.site} has no key for {', '.join(gaps)}")
        return paths

    def new_rows(self, folder: Path, missing: str, what: str) -> None:
        hits = files.find_files(folder, self.site)
        if not hits:
            self.error(missing, f"{self.site} has no {what} in {folder.name}")
            return
        df = self.read(hits[0], files.NEEDED_NEW, what, "Sheet1")
        # the same rule as the flows': absent and unreadable keys are new rows too
        if df is not None and df.where(is_new(F.col("charge_key"))).isEmpty():
            self.warn("no_new_charges", f"{what} has no new rows")


def check_primary(data: str | Path, output: str | Path, cfg: PrimaryConfig, spark: SparkSession) -> Report:
    c = _Checks(spark, cfg.site)
    data, output = Path(data), Path(output)
    if not c.configured(cfg) or not c.folders(data, output):
        return c.report()
    paths = c.years(data, cfg.reference_years(), "reference_missing", "reference_years_missing")
    read = [c.read(p, files.NEEDED, "key") for p in paths]
    if paths and not any(modelled(df.columns) for df in read if df is not None):
        c.warn("attribute_schema_empty", "the keys have no chrg_type columns; nothing can be reranked")
    c.new_rows(data / f"{cfg.target_year}_d", "diagnostic_missing", "diagnostic")
    previous = cfg.reference_years()[-1]
    starts = files.find_files(data / f"{cfg.target_year}_c", cfg.site) or files.find_files(data / f"{previous}_c", cfg.site)
    if not starts and not files.intermediary(output, cfg.site, previous).exists():
        c.warn("starting_key_missing", "there is no key to start from; the output will hold new rows only")
    return c.report()


def check_secondary(data: str | Path, output: str | Path, cfg: SecondaryConfig, spark: SparkSession) -> Report:
    c = _Checks(spark, cfg.site)
    data, output = Path(data), Path(output)
    if not c.configured(cfg) or not c.folders(data, output):
        return c.report()
    made = files.intermediary(output, cfg.site, cfg.target_year)
    raw = files.find_files(data / f"{cfg.target_year}_c", cfg.site)
    if made.exists():
        c.read(made, files.NEEDED, "finalized key", "Charge Key", "finalized_key_unreadable")
    elif raw:
        c.read(raw[0], files.NEEDED, "finalized key")
    else:
        c.error("finalized_jail_key_missing", f"{cfg.site} has no finalized key for {cfg.target_year}")
    c.new_rows(data / f"{cfg.target_year}_court_d", "court_diagnostic_missing", "diagnostic")
    for p in c.years(data, cfg.reference_years(), "training_keys_missing", "training_years_missing"):
        c.read(p, files.NEEDED, "training key")
    return c.report()
