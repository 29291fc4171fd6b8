"""A committee of classifiers per attribute, its votes, attribute rerank and consensus.

Rows carry ``query_id`` and a unit ``vector``; predictions stay columns (one
long table of attribute, model, vote, probability), so nothing is gathered.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.functions.text import dot, flag

SEED = 42
MODELS = ("forest", "boosting", "svm", "bayes", "perceptron")


@dataclass
class Member:
    """One fitted model; an SVM comes with the folds' Platt scalings, averaged."""

    model: object
    scalings: list[object] = field(default_factory=list)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with vote (int) and probability of class 1."""
        out = self.model.transform(rows)
        if self.scalings:
            p = F.lit(0.0)
            margin = vector_to_array("rawPrediction")[1]
            for s in self.scalings:
                p = p + 1 / (1 + F.exp(-(margin * float(s.coefficients[0]) + float(s.intercept))))
            p = p / len(self.scalings)
        else:
            p = vector_to_array("probability")[1]
        return out.select(*rows.columns, F.col("prediction").cast("int").alias("vote"), p.alias("probability"))


def _estimator(name: str, size: int):
    if name == "forest":
        return RandomForestClassifier(numTrees=100, weightCol="weight", seed=SEED)
    if name == "boosting":
        return GBTClassifier(seed=SEED, maxIter=50)
    if name == "svm":
        return LinearSVC(weightCol="weight")
    if name == "bayes":
        return NaiveBayes(modelType="gaussian")
    return MultilayerPerceptronClassifier(layers=[size, 128, 2], maxIter=500, seed=SEED)


def trainable(labelled: DataFrame, attr: str, min_class_count: int) -> bool:
    """Two classes at least, and the smallest of them large enough."""
    counts = labelled.where(flag(F.col(f"`{attr}`")).isNotNull()).groupBy(flag(F.col(f"`{attr}`")).alias("c")).count()
    got = counts.agg(F.count("*").alias("classes"), F.min("count").alias("least")).first()
    return got.classes >= 2 and got.least >= min_class_count


def train(rows: DataFrame, attrs: list[str], min_class_count: int = 5, models: tuple[str, ...] = MODELS) -> dict[str, dict[str, Member]]:
    """Attribute -> model name -> fitted member. A model that fails is left out with a warning."""
    panel: dict[str, dict[str, Member]] = {}
    for attr in attrs:
        if not trainable(rows, attr, min_class_count):
            continue
        data = rows.select(array_to_vector("vector").alias("features"), F.size("vector").alias("n"), flag(F.col(f"`{attr}`")).cast("double").alias("label")).where("label is not null")
        counts = data.groupBy("label").agg(F.count("*").alias("m"))
        total = data.agg(F.count("*").alias("total"))
        classes = counts.count()
        weighted = data.join(F.broadcast(counts), "label").crossJoin(F.broadcast(total)).withColumn("weight", F.col("total") / (classes * F.col("m"))).persist()
        size = weighted.first()["n"]
        members = {}
        for name in models:
            try:
                fitted = _estimator(name, size).fit(weighted)
                members[name] = Member(fitted, _platt(weighted) if name == "svm" else [])
            except Exception as problem:  # one model's failure must not end the run
                warnings.warn(f"{name} was not fitted for {attr}: {problem}", stacklevel=2)
        weighted.unpersist()
        if members:
            panel[attr] = members
    return panel


def _platt(data: DataFrame, folds: int = 3) -> list[object]:
    """A logistic scaling of the margin from each fold's held-out rows."""
    dealt = data.withColumn("fold", F.pmod(F.xxhash64("features", "label"), F.lit(folds)).cast("int")).persist()
    classes = {(r.fold, r.label) for r in dealt.select("fold", "label").distinct().collect()}
    full = [k for k in range(folds) if all({v for f, v in classes if (f == k) == held} == {0.0, 1.0} for held in (True, False))]
    out = []
    for k in full or [-1]:  # without a usable fold the scaling is fitted on all rows
        model = LinearSVC(weightCol="weight").fit(dealt.where(F.col("fold") != k))
        margins = model.transform(dealt.where((F.col("fold") == k) | F.lit(k < 0)))
        margins = margins.select("label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features"))
        out.append(LogisticRegression(regParam=1e-3).fit(margins))
    dealt.unpersist()
    return out


def votes(rows: DataFrame, panel: dict[str, dict[str, Member]]) -> DataFrame:
    """(query_id, attr, model, vote, probability)."""
    base = rows.select("query_id", array_to_vector("vector").alias("features"))
    parts = [
        member.predict(base).select("query_id", F.lit(attr).alias("attr"), F.lit(name).alias("model"), "vote", "probability")
        for attr, members in panel.items()
        for name, member in members.items()
    ]
    if not parts:
        kind = dict(rows.dtypes)["query_id"]
        return rows.sparkSession.createDataFrame([], f"query_id {kind}, attr string, model string, vote int, probability double")
    return reduce(DataFrame.unionAll, parts)


def profile(votes_: DataFrame) -> DataFrame:
    """(query_id, attr, p): mean probability over the models."""
    return votes_.groupBy("query_id", "attr").agg(F.avg("probability").alias("p"))


def agreement(candidates: DataFrame, profiles: DataFrame, attrs: list[str]) -> DataFrame:
    """(query_id, ref_id, agreement): mean of p where the candidate has the attribute, of 1 - p where not; 0 without attributes."""
    values = F.explode(F.array(*[F.struct(F.lit(a).alias("attr"), F.coalesce(flag(F.col(f"`{a}`")), F.lit(0)).alias("v")) for a in attrs]))
    keys = candidates.select("query_id", "ref_id")
    if not attrs:
        return keys.withColumn("agreement", F.lit(0.0))
    long = candidates.select("query_id", "ref_id", values.alias("a")).select("query_id", "ref_id", "a.*")
    scored = long.join(profiles, ["query_id", "attr"]).withColumn("s", F.when(F.col("v") == 1, F.col("p")).otherwise(1 - F.col("p")))
    got = scored.groupBy("query_id", "ref_id").agg(F.avg("s").alias("agreement"))
    return keys.join(got, ["query_id", "ref_id"], "left").na.fill(0.0, ["agreement"])


def nearest(queries: DataFrame, ref: DataFrame, k: int) -> DataFrame:
    """The k most similar reference rows of each query; ties to the larger ref_pos."""
    pairs = queries.select("query_id", F.col("vector").alias("qv")).crossJoin(ref)
    pairs = pairs.withColumn("cosine", dot(F.col("qv"), F.col("vector"))).drop("qv", "vector")
    order = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), F.col("ref_pos").desc())
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def rerank(candidates: DataFrame, agreed: DataFrame, similarity_weight: float = 0.6, attribute_weight: float = 0.4) -> DataFrame:
    """(query_id, ref_id, combined, margin): the best candidate; the margin is to the second, or to 0."""
    scored = candidates.join(agreed, ["query_id", "ref_id"])
    scored = scored.withColumn("combined", F.lit(similarity_weight) * F.col("cosine") + F.lit(attribute_weight) * F.col("agreement"))
    order = Window.partitionBy("query_id").orderBy(F.col("combined").desc(), F.col("ref_pos").desc())
    ranked = scored.withColumns({"__n": F.row_number().over(order), "__second": F.lead("combined").over(order)})
    return ranked.where("__n = 1").select("query_id", "ref_id", "combined", (F.col("combined") - F.coalesce("__second", F.lit(0.0))).alias("margin"))


def majority(mean_vote: Column) -> Column:
    """Half-even rounding: an even split is a vote for 0."""
    return F.bround(mean_vote).cast("int")


def resolve(matched: DataFrame, votes_: DataFrame, attrs: list[str], agreement_at: float = 0.8, probability_at: float = 0.85) -> DataFrame:
    """Consensus per query.

    ``matched`` has query_id and the copied attributes. Gives query_id, disagreements, resolved, confidence
    (least mean probability among disagreeing attributes, 1 without), unresolved, and ``overrides``, a map of
    attribute to value for those that were resolved one by one.
    """
    kind = dict(matched.dtypes)["query_id"]
    if attrs:
        pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attr"), F.coalesce(flag(F.col(f"`{a}`")), F.lit(0)).alias("own")) for a in attrs]))
        own = matched.select("query_id", pairs.alias("a")).select("query_id", "a.*")
    else:
        own = matched.sparkSession.createDataFrame([], f"query_id {kind}, attr string, own int")
    mean = votes_.groupBy("query_id", "attr").agg(F.avg("vote").alias("mean_vote"), F.avg("probability").alias("p"))
    judged = votes_.join(mean, ["query_id", "attr"]).withColumn("major", majority(F.col("mean_vote")))
    judged = judged.groupBy("query_id", "attr", "major", "p").agg(F.avg((F.col("vote") == F.col("major")).cast("double")).alias("agree"))
    sure = F.when(F.col("major") == 1, F.col("p")).otherwise(1 - F.col("p"))
    # rounded, so that the order of a sum does not decide at a threshold
    rows = own.join(judged, ["query_id", "attr"]).withColumn("sure", F.round(sure, 9)).where("major <> own")
    rows = rows.withColumn("settled", (F.col("agree") >= agreement_at) & (F.col("sure") >= probability_at))
    got = rows.groupBy("query_id").agg(
        F.count("*").alias("disagreements"),
        F.count_if("settled").alias("resolved"),
        F.bround(F.least(F.lit(1.0), F.min("sure")), 4).alias("confidence"),
        F.bool_or(~F.col("settled")).alias("unresolved"),
        F.map_from_entries(F.collect_list(F.when(F.col("settled"), F.struct("attr", "major")))).alias("overrides"),
    )
    out = matched.select("query_id").join(got, "query_id", "left")
    return out.na.fill(0, ["disagreements", "resolved"]).na.fill(1.0, ["confidence"]).na.fill(False, ["unresolved"])


def overridden(matched: DataFrame, resolved: DataFrame, attrs: list[str]) -> DataFrame:
    """``matched`` joined to its consensus, resolved attributes replaced."""
    joined = matched.join(resolved, "query_id")
    return joined.withColumns({a: F.coalesce(F.element_at("overrides", a), flag(F.col(f"`{a}`"))) for a in attrs}) if attrs else joined
