"""The secondary flow: descriptions alone against the finalized key, checked by a committee."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import contracts
from kelpline.config import SecondaryConfig
from kelpline.functions.embed import Embedder, HashedNgrams, embedded
from kelpline.functions.text import is_new, usable
from kelpline.operators import dedupe, match, panel
from kelpline.plans.preflight import check_secondary
from kelpline.plans.primary import Run
from kelpline.sources import files, sinks


def match_new(new: DataFrame, key: DataFrame, training: DataFrame, cfg: SecondaryConfig, embedder: Embedder, models=panel.MODELS) -> DataFrame:
    """Results of new rows against the finalized key (with ref_pos); ``training`` feeds the committee."""
    vector = embedded(embedder, F.upper("desc"))
    first = dedupe.keep_first(new.select("chrg_code", "chrg_desc", "load_seq"), ["chrg_code", "chrg_desc"], "load_seq").where(usable(F.col("chrg_desc")))
    queries = first.select(F.col("load_seq").alias("query_id"), F.col("chrg_code").alias("code"), F.col("chrg_desc").alias("desc")).withColumn("vector", vector).persist()
    carried = contracts.carried(key.columns)
    own = [F.col(f"`{c}`") for c in carried]
    catalogue = key.select(F.col("ref_pos").alias("ref_id"), "ref_pos", F.col("chrg_code").alias("code"), F.col("chrg_desc").alias("desc"), *own).withColumn("vector", vector).persist()
    attrs = [c for c in contracts.modelled(key.columns) if c in training.columns]
    committee = panel.train(training.withColumn("desc", F.col("chrg_desc")).withColumn("vector", vector), attrs, cfg.min_class_count, models)
    matched = match.cascade(queries, catalogue, cfg.fuzzy, cfg.similarity, by_code=False)
    side = catalogue.select("ref_id", F.col("code").alias("matched_jail_chrg_code"), F.col("desc").alias("matched_jail_chrg_desc"), *own)
    rows = matched.join(side, "ref_id", "left").join(queries.select("query_id", F.col("code").alias("court_chrg_code"), F.col("desc").alias("court_chrg_desc")), "query_id")
    judged = panel.resolve(rows, panel.votes(queries, committee), list(committee), cfg.agreement, cfg.probability)
    final = panel.overridden(rows, judged, list(committee))
    return final.select(
        "query_id", F.lit(cfg.site).alias("site"), "court_chrg_code", "court_chrg_desc", "matched_jail_chrg_code", "matched_jail_chrg_desc",
        F.bround("score", 4).alias("similarity_score"), F.col("method").alias("match_method"), F.col("needs_review").alias("low_similarity"), *own,
        F.col("disagreements").alias("disagreement_count"), F.col("resolved").alias("auto_resolved_count"), F.col("confidence").alias("consensus_confidence"),
        (F.col("unresolved") | F.col("needs_review")).alias("needs_human_review"),
    )


def run(spark: SparkSession, data: str, output: str, cfg: SecondaryConfig, embedder: Embedder | None = None, models=panel.MODELS, workbook: bool = True) -> Run:
    check_secondary(data, output, cfg, spark).raise_for_errors()
    key = dedupe.finalized(files.finalized_key(spark, data, output, cfg.site, cfg.target_year))
    key = dedupe.with_position(key, "ref_pos", "load_seq").persist()
    new = files.secondary_diagnostic(spark, data, cfg.site, cfg.target_year).where(is_new(F.col("charge_key")))
    raw = files.history(spark, data, cfg.site, cfg.reference_years())
    training = dedupe.finalized(files.preprocess(raw, cfg.site))
    results = match_new(new, key, training, cfg, embedder or HashedNgrams(), models).persist()
    tables = {k: v.drop("query_id") for k, v in sinks.secondary_tables(results).items()}
    path = sinks.write_xlsx(tables, sinks.secondary_path(output, cfg.site, cfg.target_year)) if workbook else None
    return Run(results, tables, sinks.secondary_summary(results), path)
