import collections
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from kelpline.llm import outliers as o

SCHEMA = "doc_id long, text string, lang string, source string, words string, grp int, d2 double"


def base(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def edge(values, share):
    bins = np.sort(np.floor(o.BINS * np.log1p(values)))
    return np.expm1((bins[int(np.ceil(share * len(bins))) - 1] + 1) / o.BINS)


FLOOR2 = np.diag(np.array(o.FLOOR) ** 2)


def away(x, mean, cov):
    return np.einsum("ij,ij->i", x - mean, np.linalg.solve(cov, (x - mean).T).T)


def moments(x, scale=1.0):
    return x.mean(0), np.cov(x.T, bias=True) * scale + FLOOR2


def concentrated(x, mean, cov):
    d = away(x, mean, cov)
    return moments(x[d <= edge(d, o.H)], o._consistency(o.H))


def log_det(cov):
    return np.linalg.slogdet(cov)[1]


def least(x):
    mean = np.array([edge(c, 0.5) for c in x.T])
    mad = np.array([edge(np.abs(c - m), 0.5) for c, m in zip(x.T, mean, strict=True)])
    first = mean, np.diag((1.4826 * mad) ** 2) + FLOOR2
    d = away(x, *first)
    starts = [first, moments(x[d <= edge(d, 0.5)]), moments(x)]
    for _ in range(o.STEPS):
        starts = [concentrated(x, *s) for s in starts]
    return min(starts, key=lambda s: round(log_det(s[1]), 9))


def mcd(x):
    best = least(x)
    for _ in range(o.FURTHER):
        before, best = best, concentrated(x, *best)
        if abs(log_det(before[1]) - log_det(best[1])) < o.SETTLED:
            break
    d = away(x, *best)
    return away(x, *moments(x[d <= o.chi2_quantile(0.975, 5)], o._consistency(0.975)))


def test_starts_reach_the_smallest_determinant():
    """As small as the best of 300 random starts, among a fifth of outliers."""
    rng = np.random.default_rng(9)
    for shift in (2, 4):
        x = np.abs(np.concatenate([rng.normal(5, 1, (240, 5)), rng.normal(5 + shift, 0.3, (60, 5))]))
        found = []
        for _ in range(300):
            s = moments(x[rng.choice(len(x), 6, replace=False)])
            for _ in range(10):
                s = concentrated(x, *s)
            found.append(log_det(s[1]))
        best = least(x)
        for _ in range(o.FURTHER):
            best = concentrated(x, *best)
        assert log_det(best[1]) <= min(found) + 0.05


def test_chi_square():
    assert o.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)
    assert o.chi2_quantile(0.75, 5) == pytest.approx(6.6257, abs=1e-3)
    assert o.chi2_cdf(14.067, 7) == pytest.approx(0.95, abs=1e-4)


def test_base_statistics_and_edge_rows(spark):
    texts = [
        None, "", "a b c a b c", "x x x x x", "  one", "l one\nl two\nl one\n\n \nl one", "a#b $ %%", "wörd " * 70,
        " ".join(f"w{i}" for i in range(60)), "one two three " * 30 + " ".join(f"t{i}" for i in range(9)), "a\x0bb\x0cc\rd\te",
        " ".join(f"w{i % 5000}" for i in range(20000)),
    ]
    rows = [(i, t, None if i % 2 else "en", None, "clash", 1, 1.0) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", "c", 1, 1.0), (None, "a", None, None, None, None, None)]
    got = {}
    for r in o.assess(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[3]) == 2
    for i, t in enumerate(texts):
        r = got[i][0]
        want = base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)  # too few rows for an estimate


def test_empty_table(spark):
    assert o.assess(spark.createDataFrame([], SCHEMA)).collect() == []


def test_distances_match_numpy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    from pyspark.sql import functions as F

    docs = docs.withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"))
    got = {r.doc_id: r for r in o.assess(docs).collect()}
    rows = docs.collect()
    for name in ("even", "odd"):
        ids = [r.doc_id for r in rows if r.source == name]
        stats = np.array([base(r.text) for r in rows if r.source == name], dtype=float)
        n, c = np.maximum(stats[:, 0], 1), np.maximum(stats[:, 1], 1)
        x = np.stack([np.log1p(stats[:, 0]), np.log(c / n), np.log1p(100 * stats[:, 2] / c), np.log1p(stats[:, 3]), np.arcsin(np.sqrt(stats[:, 4] / n))], 1)
        want = mcd(x)
        assert np.allclose([got[i].d2 for i in ids], want, rtol=1e-6)


def test_planted_outliers_are_rejected_and_clean_texts_kept(spark):
    """Texts with a symbol for every seventh to ninth character, among clean ones of two groups."""
    rng = np.random.default_rng(4)
    rows, planted = [], set()
    for lang in ("en", "de"):
        for k in range(150):
            words = ["".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) for _ in range(rng.integers(80, 300))]
            if k % 25 == 0:
                planted.add(len(rows))
                words = list("".join(c + "#" * (i % (7 + k // 25 % 3) == 0) for i, c in enumerate(" ".join(words))).split(" "))
            rows.append((len(rows), " ".join(words), lang, "s", None, None, None))
    got = o.assess(spark.createDataFrame(rows, SCHEMA)).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == planted
