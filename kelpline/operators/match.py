"""The match cascade: exact, then fuzzy, then semantic, each on what the one before left.

Fuzzy matching joins distinct token-sorted texts on their length, for the
lengths at which the threshold can be reached at all: an equi-join that loses
nothing, since a best score under the threshold is discarded anyway. A count of
shared characters bounds the score before the kernel runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.functions.similarity import lcs
from kelpline.functions.text import dot, sorted_tokens

RESULT = ["query_id", "ref_id", "score", "method", "needs_review"]


def exact(queries: DataFrame, ref: DataFrame, by_code: bool = True) -> DataFrame:
    """(query_id, ref_id): equal texts in capitals; the earliest reference row of each."""
    keys = ["k_code", "k_desc"] if by_code else ["k_desc"]
    keyed = lambda df: df.withColumns({"k_code": F.upper("code"), "k_desc": F.upper("desc")})
    first = keyed(ref).groupBy(*keys).agg(F.min_by("ref_id", "ref_pos").alias("ref_id"))
    return keyed(queries).select("query_id", *keys).join(first, keys).select("query_id", "ref_id")


def fuzzy(queries: DataFrame, ref: DataFrame, threshold: float = 90.0, kernel=lcs) -> DataFrame:
    """(query_id, ref_id, ratio): best token-sorted ratio at or above the threshold; ties to the earliest row."""
    texts = lambda df: df.withColumn("text", sorted_tokens(F.upper("desc")))
    q, r = texts(queries), texts(ref)
    one_q = q.select("text").distinct().withColumnRenamed("text", "a")
    one_r = r.groupBy(F.col("text").alias("b")).agg(F.min_by("ref_id", "ref_pos").alias("ref_id"), F.min("ref_pos").alias("ref_pos"))
    t = float(threshold)
    n = F.length("a")
    low = F.ceil(n * t / (200 - t)) if t < 200 else n
    high = F.when(F.lit(t > 0), F.floor(n * (200 - t) / max(t, 1e-9)))
    if t <= 0:
        pairs = one_q.crossJoin(one_r)  # no length can be ruled out
    else:
        banded = one_q.withColumn("size", F.explode(F.sequence(low.cast("int"), F.greatest(high, low).cast("int"))))
        pairs = banded.join(one_r.withColumn("size", F.length("b")), "size")
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    distinct_shared = F.size(F.array_intersect(chars("a"), chars("b")))
    lost = F.size(F.array_except(chars("a"), chars("b"))) + F.size(F.array_except(chars("b"), chars("a")))
    total = F.length("a") + F.length("b")
    may = (total == 0) | ((100.0 * (total - lost) >= t * total) & ((distinct_shared > 0) | F.lit(t <= 0)))
    scored = pairs.where(may).withColumn("common", kernel(F.col("a"), F.col("b")))
    kept = scored.where((total == 0) | (200.0 * F.col("common") >= t * total))
    value = F.when(total == 0, F.lit(100.0)).otherwise(200.0 * F.col("common") / total)
    best = kept.groupBy("a").agg(F.max_by(F.struct("ref_id", value.alias("ratio")), F.struct(value, -F.col("ref_pos"))).alias("m"))
    return q.join(best, q["text"] == best["a"]).select("query_id", "m.ref_id", "m.ratio")


def semantic(queries: DataFrame, ref: DataFrame) -> DataFrame:
    """(query_id, ref_id, cosine): best dot product of unit vectors; ties to the earliest row.

    Equal vectors are compared once; each query distinct vector meets each distinct reference vector.
    """
    one = ref.groupBy("vector").agg(F.min_by("ref_id", "ref_pos").alias("ref_id"), F.min("ref_pos").alias("ref_pos"))
    pairs = queries.select("query_id", F.col("vector").alias("qv")).crossJoin(one)
    value = dot(F.col("qv"), F.col("vector"))
    best = pairs.select("query_id", "ref_id", "ref_pos", value.alias("cosine")).groupBy("query_id")
    return best.agg(F.max_by(F.struct("ref_id", "cosine"), F.struct(F.col("cosine"), -F.col("ref_pos"))).alias("m")).select("query_id", "m.*")


def cascade(queries: DataFrame, ref: DataFrame, fuzzy_threshold: float = 90.0, similarity: float = 0.85, by_code: bool = True, kernel=lcs) -> DataFrame:
    """RESULT rows for every query. ``vector`` columns are optional; without them the rest is unmatched."""
    hit = exact(queries, ref, by_code)
    out = hit.select("query_id", "ref_id", F.lit(1.0).alias("score"), F.lit("exact").alias("method"), F.lit(False).alias("needs_review"))
    left = queries.join(hit, "query_id", "left_anti")
    near = fuzzy(left, ref, fuzzy_threshold, kernel)
    out = out.unionAll(near.select("query_id", "ref_id", F.col("ratio") / 100, F.lit("fuzzy"), F.lit(False)))
    left = left.join(near, "query_id", "left_anti")
    if "vector" in queries.columns and "vector" in ref.columns:
        far = semantic(left, ref)
        return out.unionAll(far.select("query_id", "ref_id", "cosine", F.lit("embedding"), F.col("cosine") < similarity))
    none = F.lit(None).cast(dict(ref.dtypes)["ref_id"])
    return out.unionAll(left.select("query_id", none, F.lit(0.0), F.lit("unmatched"), F.lit(True)))


def code_only(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows without a description, by code: RESULT with exact_code, exact_code_conflict or code_only_unmatched."""
    g = groups.select(F.col("code").alias("__code"), "ref_id", "conflict")
    joined = queries.join(g, F.col("code") == F.col("__code"), "left")
    known = F.col("__code").isNotNull()
    method = F.when(~known, "code_only_unmatched").when(F.col("conflict"), "exact_code_conflict").otherwise("exact_code")
    return joined.select(
        "query_id", "ref_id", F.when(known, F.lit(1.0)).otherwise(F.lit(0.0)).alias("score"), method.alias("method"),
        (~known | F.coalesce(F.col("conflict"), F.lit(True))).alias("needs_review"),
    )
