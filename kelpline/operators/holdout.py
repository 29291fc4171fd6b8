"""Temporal holdout: train on the years before, judge on a later year's rows, some of them novel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpline.config import HoldoutConfig, NoiseConfig
from kelpline.functions.similarity import lcs
from kelpline.functions.text import number
from kelpline.operators import noise, pairwise
from kelpline.operators.dedupe import with_position
from kelpline.operators.ranking import rank_candidates


def cut(history: DataFrame, cfg: HoldoutConfig) -> DataFrame:
    """Rows of years before the holdout year, ref_pos counted anew among them. A row without a year is an error."""
    if cfg.year_col not in history.columns:
        raise ValueError(f"history has no column {cfg.year_col}")
    year = number(F.col(cfg.year_col))
    bad = history.where(year.isNull()).limit(5).collect()
    if bad:
        raise ValueError(f"rows without a numeric year: {[r['ref_id'] for r in bad]}")
    kept = history.where(year < cfg.year)
    if kept.limit(2).count() < 2:
        raise ValueError("two history rows before the holdout year are needed at least")
    order = kept.withColumnRenamed("ref_pos", "__old_pos")
    return with_position(order, "ref_pos", "__old_pos").drop("__old_pos")


def check_queries(queries: DataFrame, cfg: HoldoutConfig) -> None:
    if "target" not in queries.columns:
        raise ValueError("queries have no column target")
    if queries.isEmpty():
        raise ValueError("there are no holdout queries")
    if cfg.year_col in queries.columns:
        bad = queries.where(~F.coalesce(number(F.col(cfg.year_col)) == cfg.year, F.lit(False))).limit(5).collect()
        if bad:
            raise ValueError(f"queries of other years: {[r['query_id'] for r in bad]}")


def fit_reranker(training: DataFrame, cfg: HoldoutConfig, kernel=lcs) -> tuple[pairwise.Reranker, DataFrame]:
    """(model, noisy training queries) from the cut reference alone."""
    made = noise.generate(training, NoiseConfig(cfg.variants, cfg.seed))
    queries = made.withColumn("query_id", F.concat_ws("/", F.col("target").cast("string"), F.col("variant").cast("string")))
    ranked = rank_candidates(queries.select("query_id", "code", "desc", "target"), training, cfg.retrieval, kernel).persist()
    model = pairwise.fit(pairwise.pair_examples(ranked, cfg.negatives), cfg.strength)
    ranked.unpersist()
    return model, made


def margins(reranked: DataFrame) -> DataFrame:
    """(query_id, margin): best minus second rerank score; infinite with one candidate."""
    order = Window.partitionBy("query_id").orderBy("new_rank")
    gap = F.col("rerank_score") - F.lead("rerank_score").over(order)
    return reranked.withColumn("margin", F.coalesce(gap, F.lit(float("inf")))).where("new_rank = 1").select("query_id", "margin")


def judge(reranked: DataFrame, training: DataFrame) -> DataFrame:
    """Per query: mapped or novel, ranks of the target, top candidates, margin, correctness."""
    at = F.col("ref_id") == F.col("target")
    top = lambda c, by: F.max(F.when(F.col(by) == 1, F.col(c)))
    got = reranked.groupBy("query_id", "target").agg(
        F.max(F.when(at, F.col("rank"))).alias("rank"), F.max(F.when(at, F.col("new_rank"))).alias("new_rank"),
        top("ref_id", "rank").alias("baseline_top"), top("ref_id", "new_rank").alias("reranked_top"),
        top("score", "rank").alias("baseline_score"), top("rerank_score", "new_rank").alias("rerank_score"),
    )
    known = training.select(F.col("ref_id").alias("__known")).distinct()
    joined = got.join(known, F.col("target") == F.col("__known"), "left").join(margins(reranked), "query_id")
    mapped = F.col("__known").isNotNull()
    right = lambda c: mapped & F.coalesce(F.col(c) == F.col("target"), F.lit(False))
    return joined.select(
        *got.columns, mapped.alias("is_mapped"), (~mapped).alias("is_novel"), "margin",
        right("baseline_top").alias("baseline_correct"), right("reranked_top").alias("reranked_correct"),
    )


def mapped_metrics(judged: DataFrame, cuts: list[int]) -> DataFrame:
    mapped = judged.where("is_mapped")
    top1 = mapped.agg(F.avg((F.col("rank") == 1).cast("double")).alias("baseline_top1"), F.avg((F.col("new_rank") == 1).cast("double")).alias("reranked_top1"))
    return pairwise.compare(mapped, cuts).crossJoin(top1)


def acceptance(judged: DataFrame, margin: float) -> DataFrame:
    """One row; an accepted novel row counts as wrong. Shares of nothing are null."""
    ok, novel = F.col("margin") >= margin, F.col("is_novel")
    return judged.agg(
        F.lit(float(margin)).alias("margin"),
        F.count_if(ok).alias("auto_matches"),
        F.count_if(~ok).alias("reviews"),
        F.avg((~ok).cast("double")).alias("review_rate"),
        F.avg(F.when(ok, (F.col("is_mapped") & F.col("reranked_correct")).cast("double"))).alias("auto_precision"),
        F.count_if(novel & ok).alias("novel_accepted"),
        F.avg(F.when(novel, (~ok).cast("double"))).alias("novel_review_rate"),
    )


def coverage(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count("*").alias("n_queries"), F.count_if("is_mapped").alias("n_mapped"), F.count_if("is_novel").alias("n_novel"),
        F.coalesce(F.avg(F.col("is_mapped").cast("double")), F.lit(0.0)).alias("mapped_coverage"),
    )


def evaluate(history: DataFrame, queries: DataFrame, cfg: HoldoutConfig | None = None, kernel=lcs) -> tuple[DataFrame, DataFrame, pairwise.Reranker]:
    """(summary of one row, per query, model)."""
    cfg = cfg or HoldoutConfig()
    check_queries(queries, cfg)
    training = cut(history, cfg).persist()
    model, made = fit_reranker(training, cfg, kernel)
    ranked = rank_candidates(queries.select("query_id", "code", "desc", "target"), training, cfg.retrieval, kernel)
    judged = judge(pairwise.rerank(ranked, model), training).persist()
    sizes = history.agg(F.count("*").alias("n_history")).crossJoin(training.agg(F.count("*").alias("n_training"))).crossJoin(made.agg(F.count("*").alias("n_synthetic")))
    out = sizes.crossJoin(coverage(judged)).crossJoin(mapped_metrics(judged, cfg.retrieval.cuts).drop("n_queries")).crossJoin(acceptance(judged, cfg.margin))
    return out.withColumn("year", F.lit(cfg.year)), judged, model
