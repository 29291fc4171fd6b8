"""Scalar functions and the similarity kernel against plain Python mirrors."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelpline.functions import similarity as sim
from kelpline.functions import text as tx


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_ratio(a, b):
    return 100.0 if not a and not b else 200.0 * plain_lcs(a, b) / (len(a) + len(b))


def plain_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    s, ra, rb = (" ".join(sorted(v)) for v in (x & y, x - y, y - x))
    if s and (not ra or not rb):
        return 100.0
    gap = 1 if s else 0
    best = [100 - 100 * (len(ra) + len(rb) - 2 * plain_lcs(ra, rb)) / (2 * (len(s) + gap) + len(ra) + len(rb))]
    if s:
        best += [100 - 100 * (gap + len(z)) / (2 * len(s) + gap + len(z)) for z in (ra, rb)]
    return max(best)


@given(st.text(max_size=70), st.text(max_size=70))
@settings(max_examples=200, deadline=None)
def test_kernel(a, b):
    assert sim.lcs_length(a, b) == plain_lcs(a, b)


def test_ratios_and_the_native_twin(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    pairs = [("", ""), ("", "a"), ("a", ""), ("a b", "b a"), ("a a b", "a b"), ("abc", "xyz"), ("same", "same"), ("a b c", "a b"), ("  ", "")]
    pairs += [(" ".join(word() for _ in range(rng.randint(1, 5))), " ".join(word() for _ in range(rng.randint(1, 5)))) for _ in range(80)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        "i", sim.lcs(a, b).alias("u"), sim.lcs_native(a, b).alias("n"), sim.ratio(a, b).alias("r"), sim.token_sort_ratio(a, b).alias("sort"),
        sim.token_set_ratio(a, b).alias("set"), sim.token_set_ratio(a, b, sim.lcs_native).alias("set_native"),
    ).collect()
    for r in got:
        x, y = pairs[r.i]
        assert r.u == r.n == plain_lcs(x, y)
        assert r.r == pytest.approx(plain_ratio(x, y))
        assert r.sort == pytest.approx(plain_ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split()))))
        assert r.set == r.set_native == pytest.approx(plain_set(x, y))


def plain_ngrams(text, low, high):
    out = []
    for w in text.split():
        w = f" {w} "
        for n in range(low, high + 1):
            if n > low and len(w) < n:
                break
            out += [w[i : i + n] for i in range(max(len(w) - n, 0) + 1)]
    return Counter(out)


def test_ngrams(spark):
    texts = ["", "a", "ab", "abc", "abcdef gh", "  x  yz ", "Ünï"]
    for low, high in ((3, 5), (1, 2), (4, 4)):
        rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.char_ngrams(F.col("t"), low, high).alias("g")).collect()
        for r in rows:
            assert Counter(r.g) == plain_ngrams(r.t, low, high)


def test_normalisation(spark):
    rows = [(None,), ("",), (" n/a ",), ("NaN",), ("null",), ("None",), (" ab 1\t",), (" x ",), ("a\n\n b",)]
    df = spark.createDataFrame(rows, "x string")
    x = F.col("x")
    got = df.select(tx.normalize_code(x), tx.normalize_description(x, lower=True), tx.squeeze(x), tx.search_text(x), tx.strip_code(x)).collect()
    assert [r[0] for r in got] == ["", "", "", "", "", "", "AB 1", "X", "A\n\n B"]
    assert got[6][1] == "ab 1" and got[8][2] == "a b" and got[8][3] == "A B" and [got[k][4] for k in (0, 2, 6)] == ["", "NA", "AB1"]


def test_coercion_and_routes(spark):
    df = spark.createDataFrame([("0", "A", "ABC"), (None, "A", "AB-"), ("x", "", "DRUG -"), ("1", "", "A"), ("0.0", "B", "")], "k string, c string, d string")
    got = df.select(tx.is_new(F.col("k")), tx.route(F.col("c"), F.col("d")), tx.flag(F.col("k"))).collect()
    assert [r[0] for r in got] == [True, True, True, False, True]
    assert [r[1] for r in got] == ["described", "code_only", "dropped", "dropped", "code_only"]
    assert [r[2] for r in got] == [0, None, None, 1, 0]


def test_unit_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [list(r[0]) for r in df.select(tx.unit(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
