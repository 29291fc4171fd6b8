"""Candidate ranking for noisy queries, hard negatives, retrieval metrics.

Scores come from distinct text pairs and distinct code pairs, computed once
however many rows share them. TF-IDF is fitted on the reference alone and its
cosine is an equi-join on n-grams. Ranks are windows per query.

Queries have query_id, code, desc and optionally target; the reference has
ref_id, ref_pos, code, desc. Ties rank the smaller ref_pos first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.config import RetrievalConfig
from kelpline.functions.similarity import lcs, ratio, token_set_ratio, token_sort_ratio
from kelpline.functions.text import char_ngrams, search_text, strip_code, weighted

FEATURES = ("score", "code_sim", "token_sort", "token_set", "tfidf")


def tfidf_weights(texts: DataFrame, vocabulary: DataFrame | None, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """(id, gram, weight) with unit norms, and the vocabulary (gram, idf).

    ``texts`` has id and text. Without a vocabulary it is fitted on them:
    idf = ln((1 + n) / (1 + df)) + 1. Grams outside it are ignored.
    """
    counts = texts.select("id", F.explode(char_ngrams(F.col("text"), low, high)).alias("gram")).groupBy("id", "gram").agg(F.count("*").alias("tf"))
    if vocabulary is None:
        n = texts.count()
        df = counts.groupBy("gram").agg(F.count("*").alias("df"))
        vocabulary = df.select("gram", (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = counts.join(vocabulary, "gram").select("id", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    norms = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, "id").select("id", "gram", (F.col("w") / F.col("norm")).alias("weight")), vocabulary


def tfidf_cosine(queries: DataFrame, ref: DataFrame, low: int = 3, high: int = 5, corpus: DataFrame | None = None) -> DataFrame:
    """(qt, rt, tfidf) for text pairs that share a gram; ``queries`` has qt, ``ref`` has rt.

    ``corpus`` (id, text) has one row per reference row, as document frequencies count rows.
    """
    corpus = corpus if corpus is not None else ref.select(F.col("rt").alias("id"), F.col("rt").alias("text"))
    _, vocabulary = tfidf_weights(corpus, None, low, high)
    r, _ = tfidf_weights(ref.select(F.col("rt").alias("id"), F.col("rt").alias("text")), vocabulary, low, high)
    q, _ = tfidf_weights(queries.select(F.col("qt").alias("id"), F.col("qt").alias("text")), vocabulary, low, high)
    q = q.select(F.col("id").alias("qt"), "gram", F.col("weight").alias("wq"))
    r = r.select(F.col("id").alias("rt"), "gram", F.col("weight").alias("wr"))
    return q.join(r, "gram").groupBy("qt", "rt").agg(F.sum(F.col("wq") * F.col("wr")).alias("tfidf"))


def combined_score(qcode: Column, parts: dict[str, Column], cfg: RetrievalConfig) -> Column:
    """Weighted mean; a query without a code leaves the code out and the other weights are rescaled."""
    words = [(cfg.token_sort_weight, parts["token_sort"]), (cfg.token_set_weight, parts["token_set"]), (cfg.tfidf_weight, parts["tfidf"])]
    return F.when(qcode == "", weighted(words)).otherwise(weighted([(cfg.code_weight, parts["code_sim"]), *words]))


def score_pairs(queries: DataFrame, ref: DataFrame, cfg: RetrievalConfig | None = None, kernel=lcs) -> DataFrame:
    """One row per query and reference row with FEATURES."""
    cfg = cfg or RetrievalConfig()
    q = queries.withColumns({"qt": search_text(F.col("desc")), "qc": strip_code(F.col("code"))})
    r = ref.withColumns({"rt": search_text(F.col("desc")), "rc": strip_code(F.col("code"))})
    texts = q.select("qt").distinct().crossJoin(r.select("rt").distinct())
    texts = texts.withColumns({"token_sort": token_sort_ratio(F.col("qt"), F.col("rt"), kernel) / 100, "token_set": token_set_ratio(F.col("qt"), F.col("rt"), kernel) / 100})
    corpus = r.select(F.col("ref_id").alias("id"), F.col("rt").alias("text"))
    near = tfidf_cosine(q.select("qt").distinct(), r.select("rt").distinct(), *cfg.ngrams, corpus=corpus)
    texts = texts.join(near, ["qt", "rt"], "left").na.fill(0.0, ["tfidf"])
    codes = q.select("qc").distinct().crossJoin(r.select("rc").distinct())
    blank = (F.col("qc") == "") | (F.col("rc") == "")
    codes = codes.withColumn("code_sim", F.when(blank, F.lit(0.0)).otherwise(ratio(F.col("qc"), F.col("rc"), kernel) / 100))
    kept = [c for c in ("query_id", "target", "qt", "qc") if c in q.columns]
    pairs = q.select(*kept).crossJoin(r.select("ref_id", "ref_pos", "rt", "rc"))
    pairs = pairs.join(texts, ["qt", "rt"]).join(codes, ["qc", "rc"])
    parts = {k: F.col(k) for k in FEATURES[1:]}
    return pairs.withColumn("score", combined_score(F.col("qc"), parts, cfg)).drop("qt", "rt", "qc", "rc")


def rank(scored: DataFrame, by: str = "score", name: str = "rank") -> DataFrame:
    """Dense ranks from 1 per query. Scores that differ by rounding alone (12 decimals) tie."""
    order = Window.partitionBy("query_id").orderBy(F.round(by, 12).desc(), "ref_pos")
    return scored.withColumn(name, F.row_number().over(order).cast("int"))


def rank_candidates(queries: DataFrame, ref: DataFrame, cfg: RetrievalConfig | None = None, kernel=lcs) -> DataFrame:
    return rank(score_pairs(queries, ref, cfg, kernel))


def hard_negatives(ranked: DataFrame, n: int = 5) -> DataFrame:
    """The first n of each query's ranking that are not its target; ``rank`` is that in the full list."""
    order = Window.partitionBy("query_id").orderBy("rank")
    wrong = ranked.where(F.col("ref_id") != F.col("target"))
    return wrong.withColumn("negative_number", F.row_number().over(order)).where(F.col("negative_number") <= n)


def per_query(ranked: DataFrame, cuts: list[int]) -> DataFrame:
    """(query_id, target, rank, reciprocal_rank, hit_at_k...): the target's place in each ranking."""
    found = ranked.groupBy("query_id", "target").agg(F.max(F.when(F.col("ref_id") == F.col("target"), F.col("rank"))).alias("rank"))
    return found.select("*", (F.lit(1.0) / F.col("rank")).alias("reciprocal_rank"), *[(F.col("rank") <= k).alias(f"hit_at_{k}") for k in cuts])


def summary(places: DataFrame, cuts: list[int]) -> DataFrame:
    """One row; without queries all its figures are 0."""
    mean = lambda c, name: F.coalesce(F.avg(c), F.lit(0.0)).alias(name)
    return places.agg(
        F.count("*").alias("n_queries"),
        mean(F.col("reciprocal_rank"), "mrr"),
        mean(F.col("rank"), "mean_rank"),
        *[mean(F.col(f"hit_at_{k}").cast("double"), f"recall_at_{k}") for k in cuts],
    )


def check_targets(queries: DataFrame, ref: DataFrame, target: str = "target") -> None:
    """Unknown targets and repeated reference ids are errors."""
    if ref.groupBy("ref_id").count().where("count > 1").limit(1).count():
        raise ValueError("reference ids must be unique")
    unknown = queries.join(ref, queries[target] == ref["ref_id"], "left_anti").select(target).limit(5).collect()
    if unknown:
        raise ValueError(f"targets are not in the reference: {[r[0] for r in unknown]}")


def evaluate(queries: DataFrame, ref: DataFrame, cfg: RetrievalConfig | None = None, kernel=lcs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary, per query, hard negatives). Without queries the summary is zero and nothing is checked."""
    cfg = cfg or RetrievalConfig()
    if not queries.isEmpty():
        check_targets(queries, ref)
    ranked = rank_candidates(queries, ref, cfg, kernel).persist()
    places = per_query(ranked, cfg.cuts)
    return summary(places, cfg.cuts), places, hard_negatives(ranked, cfg.hard_negatives)
