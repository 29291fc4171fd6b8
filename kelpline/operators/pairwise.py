"""A linear pairwise reranker on retrieval features, grouped splits, comparison metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpline.config import RetrievalConfig
from kelpline.functions.similarity import lcs
from kelpline.operators.ranking import FEATURES, check_targets, hard_negatives, rank_candidates


@dataclass(frozen=True)
class Reranker:
    weights: dict[str, float]

    def score(self):
        """The decision value as a column expression."""
        return sum((F.col(f) * w for f, w in self.weights.items()), F.lit(0.0))


def pair_examples(ranked: DataFrame, negatives: int = 5) -> DataFrame:
    """Symmetric examples (label, d_<feature>): target minus hard negative, and its mirror."""
    mine = ranked.where(F.col("ref_id") == F.col("target")).select("query_id", *[F.col(f).alias(f"t_{f}") for f in FEATURES])
    pairs = hard_negatives(ranked, negatives).join(mine, "query_id")
    delta = F.struct(*[(F.col(f"t_{f}") - F.col(f)).alias(f"d_{f}") for f in FEATURES])
    mirror = F.struct(*[(F.col(f) - F.col(f"t_{f}")).alias(f"d_{f}") for f in FEATURES])
    both = F.array(F.struct(F.lit(1.0).alias("label"), delta.alias("d")), F.struct(F.lit(0.0).alias("label"), mirror.alias("d")))
    return pairs.select("query_id", "ref_id", "negative_number", F.explode(both).alias("e")).select("query_id", "ref_id", "negative_number", "e.label", "e.d.*")


def fit(examples: DataFrame, strength: float = 1.0) -> Reranker:
    """L2 logistic regression without intercept; ``strength`` is the inverse penalty."""
    if strength <= 0:
        raise ValueError("strength must be positive")
    examples = examples.persist()
    n = examples.count()
    if not n:
        raise ValueError("there are no training pairs")
    vector = VectorAssembler(inputCols=[f"d_{f}" for f in FEATURES], outputCol="features").transform(examples)
    model = LogisticRegression(regParam=1 / (strength * n), elasticNetParam=0.0, fitIntercept=False, standardization=False, maxIter=200, tol=1e-10).fit(vector)
    examples.unpersist()
    return Reranker(dict(zip(FEATURES, model.coefficients.toArray().tolist(), strict=True)))


def rerank(ranked: DataFrame, model: Reranker) -> DataFrame:
    """Adds rerank_score and new_rank; ``rank`` stays the baseline's and breaks ties."""
    order = Window.partitionBy("query_id").orderBy(F.round("rerank_score", 12).desc(), "rank")
    return ranked.withColumn("rerank_score", model.score()).withColumn("new_rank", F.row_number().over(order).cast("int"))


def grouped_split(queries: DataFrame, group: str = "target", test_size: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by whole groups: those with the smallest seeded hashes, ceil(test_size * groups) of them, are test.

    The choice is a top-k over distinct groups, so it needs no driver-side list.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    groups = queries.select(F.col(group).alias("__g")).distinct()
    n = groups.count()
    if n < 2:
        raise ValueError("two groups are needed at least")
    test = groups.orderBy(F.xxhash64(F.col("__g"), F.lit(seed)), "__g").limit(min(n - 1, -int(-test_size * n // 1)))
    return (
        queries.join(test, F.col(group) == F.col("__g"), "left_anti"),
        queries.join(test, F.col(group) == F.col("__g"), "left_semi"),
    )


def compare(places: DataFrame, cuts: list[int]) -> DataFrame:
    """One row of baseline and reranked metrics over (rank, new_rank); nulls where there are no rows."""
    old, new = F.col("rank"), F.col("new_rank")
    named = [
        F.count("*").alias("n_queries"),
        F.avg(1.0 / old).alias("baseline_mrr"), F.avg(1.0 / new).alias("reranked_mrr"),
        F.avg(old).alias("baseline_mean_rank"), F.avg(new).alias("reranked_mean_rank"),
        (F.avg(1.0 / new) - F.avg(1.0 / old)).alias("mrr_delta"), (F.avg(new) - F.avg(old)).alias("mean_rank_delta"),
    ]
    for k in cuts:
        b, r = F.avg((old <= k).cast("double")), F.avg((new <= k).cast("double"))
        named += [b.alias(f"baseline_recall_at_{k}"), r.alias(f"reranked_recall_at_{k}"), (r - b).alias(f"recall_at_{k}_delta")]
    counts = [("improved", new < old), ("worsened", new > old), ("unchanged", new == old)]
    return places.agg(*named, *[F.count_if(c).alias(n) for n, c in counts])


def target_places(reranked: DataFrame) -> DataFrame:
    at = F.col("ref_id") == F.col("target")
    return reranked.groupBy("query_id", "target").agg(F.max(F.when(at, F.col("rank"))).alias("rank"), F.max(F.when(at, F.col("new_rank"))).alias("new_rank"))


def evaluate(
    queries: DataFrame, ref: DataFrame, cfg: RetrievalConfig | None = None, negatives: int = 5, test_size: float = 0.3, seed: int = 42, strength: float = 1.0, kernel=lcs
) -> tuple[DataFrame, DataFrame, Reranker]:
    """(summary, per query, model). Queries are split by target; candidates are the whole reference for both parts."""
    cfg = cfg or RetrievalConfig()
    check_targets(queries, ref)
    train, test = grouped_split(queries, "target", test_size, seed)
    model = fit(pair_examples(rank_candidates(train, ref, cfg, kernel), negatives), strength)
    places = target_places(rerank(rank_candidates(test, ref, cfg, kernel), model))
    return compare(places, cfg.cuts), places, model
