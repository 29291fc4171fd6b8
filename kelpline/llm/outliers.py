"""Robust multivariate outliers: minimum-covariance-determinant rules per language and source.

Native: DataFrame operations only. Each text becomes a vector of five
transformed statistics. Per group (language, source) the estimate has three
deterministic starts: medians with median deviations, the moments of the half of
the rows nearest to those, and the moments of all rows. Each repeats concentration
steps (Rousseeuw and Van Driessen 1999): the share H of rows that lie nearest, their
moments, a Cholesky factor of their covariance, new Mahalanobis distances. After
STEPS of them the start with the smallest determinant goes on alone, until no
group's determinant changes or for FURTHER steps. A last step reweights with the
rows inside the 97.5 % ellipse. A row is rejected beyond the CUT quantile of chi-square.

Quantiles come from counts over fixed bins of the distance, moments from sums:
both combine before they shuffle, so a source with a third of all rows is no
harder than the rest, and the same rows give the same verdicts. FLOOR adds a
variance to each axis, as counts that are zero in most texts have none. Groups
under MIN_GROUP rows are pooled by language, then all together; where even that
pool is smaller, only the base rules decide.

Nulls: a null text has no words; a null language or source counts as an empty
one. Repeated rows count as often as they come. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, written
from .textstats import barrier, words

MIN_WORDS, REPEAT_PERCENT = 50, 50
H = 0.75
#: Concentration steps of every start, and at most so many more of the best one.
STEPS, FURTHER = 2, 6
#: Change of a log determinant below which a group has settled.
SETTLED = 1e-6
CUT = 0.999
MIN_GROUP = 60
#: Standard deviations added to each axis, in the units of the transformed statistics.
FLOOR = (0.35, 0.06, 0.5, 0.5, 0.12)
AXES = tuple(f"x{k}" for k in range(1, 6))
#: Bins of a quantity v >= 0: floor(BINS * ln(1 + v)).
BINS = 256


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution with an odd number of degrees of freedom."""
    total, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for j in range(1, k, 2):
        total -= term
        term *= x / (j + 2)
    return total


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 500.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _consistency(p: float) -> float:
    """What scales the covariance of the nearest share p of normal rows to that of all."""
    k = len(AXES)
    return p / chi2_cdf(chi2_quantile(p, k), k + 2)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in some 3-word window that comes twice or more in the text.

    Windows are hashed and sorted with their positions in one long each. Only
    positions whose 40 hash bits meet another's are compared as text.
    """
    tri = F.transform(
        F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("b"), F.slice("words", 3, F.greatest(F.size("words"), F.lit(1))).alias("c")),
        lambda z, i: F.xxhash64(z["a"], z["b"], z["c"]).bitwiseAND(F.lit(~0xFFFFFF)).bitwiseOR(i.cast("long")),
    )
    packed = F.when((F.size("words") >= 4) & (F.size("words") < 1 << 24), F.sort_array(F.slice(tri, 1, F.greatest(F.size("words") - 2, F.lit(1)))))
    df = barrier(df.withColumn("packed", packed))
    top = lambda c: F.shiftright(c, 24)
    p = F.col("packed")
    meets = F.filter(
        p,
        lambda x, k: ((k > 0) & (top(F.get(p, k - 1)) == top(x))) | (top(F.get(p, k + 1)) == top(x)),
    )
    at = F.when(p.isNotNull(), F.transform(meets, lambda x: x.bitwiseAND(F.lit(0xFFFFFF)).cast("int"))).when(
        F.size("words") >= 4, F.sequence(F.lit(0), F.size("words") - 3)
    ).otherwise(F.array().cast("array<int>"))
    df = barrier(df.withColumn("at", at).drop("packed"))
    text_at = lambda i: F.concat_ws(" ", F.slice("words", i + 1, 3))
    df = barrier(df.withColumn("same", F.when(F.size("at") > 1, F.sort_array(F.transform("at", lambda i: F.struct(text_at(i).alias("t"), i.alias("i")))))).drop("at"))
    s = F.col("same")
    twice = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["t"] == x["t"])) | (F.get(s, k + 1)["t"] == x["t"]))
    df = barrier(df.withColumn("hit", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("same"))
    h = F.col("hit")
    gaps = F.transform(h, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(h, k + 1) - x), F.lit(3)))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("hit")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: the base statistics, base_failed, the group's names and the axes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = barrier(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
            F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
            words(F.col(text_col)).alias("words"),
            lines.alias("lines"),
        )
    )
    joined = F.array_join("words", "")
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    df = df.withColumn("n_words", F.size("words").cast("long")).withColumn("word_chars", F.length(joined).cast("long"))
    df = df.withColumn("n_symbols", (F.length(joined) - F.length(F.regexp_replace(joined, r"[#*$%&|<>]+", ""))).cast("long"))
    df = barrier(_repeat_words(barrier(df.drop("lines"))).drop("words"))
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return df.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.log1p("n_words").alias("x1"),
        F.log(chars / n).alias("x2"),
        F.log1p(100.0 * F.col("n_symbols") / chars).alias("x3"),
        F.log1p("n_dup_lines").alias("x4"),
        F.asin(F.sqrt(F.col("n_repeat_words") / n)).alias("x5"),
    )


def _grouped(stats: DataFrame) -> DataFrame:
    """Adds grp: the smallest of (lang, source), lang and all that has enough rows; null if none has."""
    sizes = stats.groupBy("lang", "source").count()
    own = F.col("count") >= MIN_GROUP
    by_lang = sizes.where(~own).groupBy("lang").agg(F.sum("count").alias("lang_rows"))
    sizes = written(sizes.join(by_lang, "lang", "left"), "sizes")
    rest = sizes.where(~own & (F.col("lang_rows") < MIN_GROUP)).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    names = sizes.select(
        "lang", "source",
        F.when(own, F.to_json(F.struct("lang", "source")))
        .when(F.col("lang_rows") >= MIN_GROUP, F.to_json(F.struct("lang")))
        .when(F.lit(rest >= MIN_GROUP), F.lit("{}")).alias("grp"),
    )
    return stats.join(small_side(names), ["lang", "source"])


def _quantile(rows: DataFrame, values: dict[str, Column], share: float, by: tuple[str, ...] = ("grp",)) -> DataFrame:
    """Per key: the upper edge of the bin that holds the given share of each value (>= 0)."""
    one = F.explode(F.array(*[F.struct(F.lit(k).alias("what"), F.floor(BINS * F.log1p(v)).cast("long").alias("bin")) for k, v in values.items()]))
    counts = rows.select(*by, one.alias("v")).groupBy(*by, F.col("v.what").alias("what"), F.col("v.bin").alias("bin")).count()
    gathered = counts.groupBy(*by, "what").agg(F.sort_array(F.collect_list(F.struct("bin", "count"))).alias("b"), F.sum("count").alias("n"))
    # bins are at most a few thousand whatever the input: distances are finite doubles on a log scale
    found = F.aggregate(
        "b",
        F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("bin")),
        lambda a, x: F.struct(
            (a["c"] + x["count"]).alias("c"),
            F.when(a["bin"].isNull() & (a["c"] + x["count"] >= share * F.col("n")), x["bin"]).otherwise(a["bin"]).alias("bin"),
        ),
    )["bin"]
    edge = gathered.select(*by, "what", F.expm1((found + 1) / F.lit(float(BINS))).alias("edge"))
    return edge.groupBy(*by).agg(*[F.max(F.when(F.col("what") == k, F.col("edge"))).alias(k) for k in values])


def _factor(moments: DataFrame, scale: float, by: tuple[str, ...] = ("grp",)) -> DataFrame:
    """Means and Cholesky factor per key from the sums of a moments table."""
    k = len(AXES)
    df = moments.select(*by, "m", *[(F.col(f"s_{a}") / F.col("m")).alias(f"mean_{a}") for a in AXES], *[f"s_{AXES[i]}_{AXES[j]}" for i in range(k) for j in range(i + 1)])
    for i in range(k):
        for j in range(i + 1):
            cov = (F.col(f"s_{AXES[i]}_{AXES[j]}") / F.col("m") - F.col(f"mean_{AXES[i]}") * F.col(f"mean_{AXES[j]}")) * F.lit(scale)
            done = [F.col(f"l_{i}_{q}") * F.col(f"l_{j}_{q}") for q in range(j)]
            for d in done:
                cov = cov - d
            if i == j:
                df = df.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(cov + F.lit(FLOOR[i] ** 2), F.lit(1e-9))))
            else:
                df = df.withColumn(f"l_{i}_{j}", cov / F.col(f"l_{j}_{j}"))
    return df.select(*by, *[f"mean_{a}" for a in AXES], *[f"l_{i}_{j}" for i in range(k) for j in range(i + 1)])


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    keep = rows.columns
    for i, a in enumerate(AXES):
        y = F.col(a) - F.col(f"mean_{a}")
        for j in range(i):
            y = y - F.col(f"l_{i}_{j}") * F.col(f"y_{j}")
        rows = rows.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    return rows.select(*keep, sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(AXES))), F.col("y_0") * F.col("y_0")).alias("d2"))


def _moments(rows: DataFrame, by: tuple[str, ...] = ("grp",)) -> DataFrame:
    products = [F.sum(F.col(AXES[i]) * F.col(AXES[j])).alias(f"s_{AXES[i]}_{AXES[j]}") for i in range(len(AXES)) for j in range(i + 1)]
    return rows.groupBy(*by).agg(F.count("*").alias("m"), *[F.sum(a).alias(f"s_{a}") for a in AXES], *products)


def _starts(known: DataFrame) -> DataFrame:
    """(grp, start, means and factor): three estimates per grp to concentrate from."""
    center = written(_quantile(known, {a: F.col(a) for a in AXES}, 0.5).select("grp", *[F.col(a).alias(f"mean_{a}") for a in AXES]), "center")
    mad = _quantile(known.join(small_side(center), "grp"), {a: F.abs(F.col(a) - F.col(f"mean_{a}")) for a in AXES}, 0.5)
    spread = [F.sqrt(F.pow(1.4826 * F.col(a), 2) + F.lit(f * f)).alias(f"l_{i}_{i}") for i, (a, f) in enumerate(zip(AXES, FLOOR, strict=True))]
    zero = [F.lit(0.0).alias(f"l_{i}_{j}") for i in range(len(AXES)) for j in range(i)]
    median = written(center.join(mad.select("grp", *spread, *zero), "grp"), "median")
    at = _distance(known.join(small_side(median), "grp"))
    half = written(_quantile(at, {"d2": F.col("d2")}, 0.5).withColumnRenamed("d2", "edge"), "half")
    nearest = _factor(_moments(at.join(small_side(half), "grp").where("d2 <= edge")), 1.0)
    found = [median, nearest, _factor(_moments(known), 1.0)]
    one, *others = [x.withColumn("start", F.lit(k)) for k, x in enumerate(found)]
    for x in others:
        one = one.unionByName(x)
    return written(one, "starts")


def _concentrated(known: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step for each (grp, start), with log_det of the new covariance."""
    by = ("grp", "start")
    at = _distance(known.join(small_side(params), "grp"))
    cut = written(_quantile(at, {"d2": F.col("d2")}, H, by).withColumnRenamed("d2", "edge"), "cut")
    kept = at.join(small_side(cut), list(by)).where("d2 <= edge")
    roots = [F.log(f"l_{i}_{i}") for i in range(len(AXES))]
    return written(_factor(_moments(kept, by), _consistency(H), by).withColumn("log_det", 2 * sum(roots[1:], roots[0])), "mcd")


def estimates(known: DataFrame) -> DataFrame:
    """(grp, start, means and factor, log_det): the settled estimate with the smallest determinant per grp.

    Determinants that differ by rounding alone (9 decimals of the logarithm) tie; the first start wins.
    """
    params = _starts(known)
    for _ in range(STEPS):
        params = _concentrated(known, params.drop("log_det"))
    values = [c for c in params.columns if c != "grp"]
    best = params.groupBy("grp").agg(F.min_by(F.struct(*values), F.struct(F.round("log_det", 9), F.col("start"))).alias("best"))
    params = written(best.select("grp", "best.*"), "best")
    for _ in range(FURTHER):
        after = _concentrated(known, params.drop("log_det"))
        change = after.join(params.select("grp", F.col("log_det").alias("before")), "grp").agg(F.max(F.abs(F.col("log_det") - F.col("before")))).first()[0]
        params = after
        if change is None or change < SETTLED:
            break
    return params


def distances(grouped: DataFrame) -> DataFrame:
    """``grouped`` (grp and the axes) with d2; null where grp is null."""
    known = grouped.where("grp is not null").select("grp", *AXES)
    at = _distance(known.join(small_side(estimates(known)), "grp"))
    kept = at.where(F.col("d2") <= chi2_quantile(0.975, len(AXES)))
    params = written(_factor(_moments(kept), _consistency(0.975)), "mcd")
    return _distance(grouped.join(small_side(params), "grp", "left"))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, base statistics, base_failed, kept, d2."""
    stats = written(statistics(docs, id_col, text_col, lang_col, source_col), "stats")
    rows = distances(_grouped(stats))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= chi2_quantile(CUT, len(AXES)), F.lit(True))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "d2")


def query(spark, sf_dir: str) -> DataFrame:
    return assess(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("d2")
