"""The primary flow: new rows matched to the historical catalogue by code and description."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import contracts, rules
from kelpline.config import PrimaryConfig
from kelpline.functions.embed import Embedder, HashedNgrams, embedded
from kelpline.functions.text import is_new, normalize_code, route
from kelpline.operators import dedupe, match, panel
from kelpline.operators.dictionary import backfill, derive
from kelpline.plans.preflight import check_primary
from kelpline.sources import files, sinks

NO_TEXT = "NO DESCRIPTION IN SOURCE"


@dataclass
class Run:
    results: DataFrame
    tables: dict[str, DataFrame]
    summary: DataFrame
    path: Path | None = None


def dictionaries(raw: DataFrame, ref: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(newest: normalised descriptions of the catalogue; all years: original letter case), without blank codes."""
    newest = dedupe.latest_descriptions(ref, seq="ref_pos")
    coded = raw.withColumn("chrg_code", normalize_code(F.col("chrg_code"))).where(F.coalesce(F.trim("chrg_desc"), F.lit("")) != "")
    return newest, dedupe.latest_descriptions(coded)


def match_new(
    new: DataFrame, ref: DataFrame, newest: DataFrame, all_years: DataFrame, attrs: list[str], cfg: PrimaryConfig, embedder: Embedder, models=panel.MODELS
) -> DataFrame:
    """Results of new rows (chrg_code, chrg_desc, load_seq) against the catalogue (with ref_pos)."""
    filled = backfill(new, newest, all_years).withColumn("route", route(F.col("chrg_code"), F.col("chrg_desc")))
    described = dedupe.keep_first(filled.where("route = 'described'").select("chrg_code", "chrg_desc", "load_seq"), ["chrg_code", "chrg_desc"], "load_seq")
    coded = dedupe.keep_first(filled.where("route = 'code_only'").select("chrg_code", "chrg_desc", "load_seq"), ["chrg_code"], "load_seq")
    as_query = lambda df: df.select(F.col("load_seq").alias("query_id"), F.col("chrg_code").alias("code"), F.col("chrg_desc").alias("desc"))
    own = [F.col(f"`{a}`") for a in attrs]
    catalogue = ref.select(F.col("ref_pos").alias("ref_id"), "ref_pos", F.col("chrg_code").alias("code"), F.col("chrg_desc").alias("desc"), "source_year", *own)
    catalogue = catalogue.withColumn("vector", embedded(embedder, F.upper("desc"))).persist()
    queries = as_query(described).withColumn("vector", embedded(embedder, F.upper("desc"))).persist()

    matched = match.cascade(queries, catalogue, cfg.fuzzy, cfg.similarity)
    types = [a for a in attrs if a.startswith("chrg_type")]
    committee = panel.train(catalogue, types, cfg.min_class_count, models)
    unsure = matched.where("method = 'embedding' and needs_review")
    if committee:
        near = panel.nearest(queries.join(unsure.select("query_id"), "query_id"), catalogue, cfg.top_k)
        profiles = panel.profile(panel.votes(queries.join(unsure.select("query_id"), "query_id"), committee))
        agreed = panel.agreement(near, profiles, list(committee))
        better = panel.rerank(near, agreed, cfg.similarity_weight, cfg.attribute_weight)
        better = better.where((F.col("combined") >= cfg.rerank) & (F.col("margin") >= cfg.margin))
        better = better.select(F.col("query_id").alias("__q"), F.col("ref_id").alias("__r"), "combined")
        joined = matched.join(better, F.col("query_id") == F.col("__q"), "left")
        hit = F.col("__q").isNotNull()
        matched = joined.select(
            "query_id", F.coalesce("__r", "ref_id").alias("ref_id"), F.coalesce("combined", "score").alias("score"),
            F.when(hit, "ensemble").otherwise(F.col("method")).alias("method"), (F.col("needs_review") & ~hit).alias("needs_review"),
        )
    groups = dedupe.code_groups(catalogue.drop("vector"), types, code="code")
    by_code = match.code_only(as_query(coded), groups)
    inputs = described.withColumn("__kind", F.lit(0)).unionByName(coded.withColumn("__kind", F.lit(1)))
    inputs = inputs.select(F.col("load_seq").alias("query_id"), F.col("chrg_code").alias("input_chrg_code"), F.col("chrg_desc").alias("input_chrg_desc"), "__kind")
    side = catalogue.select("ref_id", F.col("code").alias("matched_chrg_code"), F.col("desc").alias("matched_chrg_desc"), *own)
    both = matched.unionByName(by_code).join(inputs, "query_id").join(side, "ref_id", "left")
    out = _review_text(both, newest, all_years)
    seq = F.struct("__kind", "query_id")
    return out.select(
        "query_id", "input_chrg_code", "input_chrg_desc", "matched_chrg_code", "matched_chrg_desc", "desc_derived",
        F.bround("score", 4).alias("similarity_score"), F.col("method").alias("match_method"), F.col("needs_review").alias("needs_human_review"),
        *own, seq.alias("result_seq"),
    ).withColumn("result_seq", F.col("result_seq.__kind").cast("long") * (1 << 60) + F.col("result_seq.query_id"))


def _review_text(df: DataFrame, newest: DataFrame, all_years: DataFrame) -> DataFrame:
    """Fills blank matched descriptions of rows in review from the dictionaries, then from related codes, then placeholders."""
    for name, d in (("__all", all_years), ("__new", newest)):
        for side in ("matched", "input"):
            looked = d.select(F.col("dict_code").alias(f"{name}_{side}_code"), F.col("dict_desc").alias(f"{name}_{side}"))
            df = df.join(looked, F.col(f"{side}_chrg_code") == F.col(f"{name}_{side}_code"), "left")
    derived = derive(df, newest, "query_id", "input_chrg_code").withColumnRenamed("query_id", "__qid")
    df = df.join(derived, F.col("query_id") == F.col("__qid"), "left")
    blank = F.coalesce(F.col("matched_chrg_desc"), F.lit("")) == ""
    fill = F.coalesce(*[F.nullif(c, F.lit("")) for c in ("__all_matched", "__new_matched", "__all_input", "__new_input", "derived_desc")])
    use = F.col("needs_review") & blank & fill.isNotNull()
    df = df.withColumns({"matched_chrg_desc": F.when(use, fill).otherwise(F.coalesce("matched_chrg_desc", F.lit(""))), "desc_derived": use})
    none = F.col("needs_review") & (F.col("matched_chrg_desc") == "") & (F.trim("input_chrg_desc") == "")
    note = F.concat(F.lit("CODE "), F.col("input_chrg_code"), F.lit(" - NOT IN REFERENCE WITH DESCRIPTION"))
    return df.withColumns(
        {
            "input_chrg_desc": F.when(none, F.lit(NO_TEXT)).otherwise(F.col("input_chrg_desc")),
            "matched_chrg_desc": F.when(none, note).otherwise(F.col("matched_chrg_desc")),
            "desc_derived": F.col("desc_derived") | none,
        }
    )


def run(spark: SparkSession, data: str, output: str, cfg: PrimaryConfig, embedder: Embedder | None = None, models=panel.MODELS, workbook: bool = True) -> Run:
    """Reads a site's files, matches its new rows, and writes the result tables."""
    check_primary(data, output, cfg, spark).raise_for_errors()
    years = cfg.reference_years()
    raw = files.history(spark, data, cfg.site, years)
    ref = dedupe.reference(files.preprocess(raw, cfg.site)).persist()
    attrs = contracts.attributes([c for c in raw.columns if c not in rules.DROPPED])
    key = files.current_key(spark, data, output, cfg.site, cfg.target_year, years[-1])
    new = files.primary_diagnostic(spark, data, cfg.site, cfg.target_year).where(is_new(F.col("charge_key")))
    if new.isEmpty():
        raise RuntimeError(f"{cfg.site} has no new rows for {cfg.target_year}")
    newest, all_years = dictionaries(raw, ref)
    results = match_new(new, ref, newest, all_years, attrs, cfg, embedder or HashedNgrams(), models).persist()
    tables = sinks.primary_tables(results, key, cfg.site, attrs)
    path = sinks.write_xlsx(tables, sinks.primary_path(output, cfg.site, cfg.target_year)) if workbook else None
    return Run(results, tables, sinks.primary_summary(results), path)
