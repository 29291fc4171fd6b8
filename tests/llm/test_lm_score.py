import math
from collections import Counter

import pytest

from kelpline.llm import lm_score, registry

from tests.oracle import same

DOCS = "doc_id long, text string, word int, n string, score double"


def test_query_matches_sql(spark, sf):
    assert same(lm_score.query(spark, sf), registry.ORACLES["op7_lm_score"], sf) >= 200


def brute(words, order, min_count):
    """Scores by counting n-grams as tuples and backing off one word at a time."""
    counts = Counter(tuple(ws[i : i + k]) for ws in words for k in range(1, order + 1) for i in range(len(ws) - k + 1))
    total = sum(map(len, words))

    def back(gram):
        if len(gram) == 1:
            return counts[gram] / total
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= min_count else lm_score.ALPHA * back(gram[1:])

    return [sum(math.log(back(tuple(ws[max(0, i - order + 1) : i + 1]))) for i in range(len(ws))) for ws in words]


@pytest.mark.parametrize("order, min_count", [(3, 1), (2, 2), (3, 2), (4, 3), (1, 1)])
def test_brute_force_and_edge_rows(spark, monkeypatch, order, min_count):
    texts = [(1, "a b a b c"), (2, "A b d a b a"), (3, None), (4, " \n"), (5, "e"), (None, "a b"), (6, "x " * 5000), (7, "a b a"), (7, "a b a"), (8, "b a b c")]
    words = [(t or "").lower().split() for _, t in texts]
    want = sorted((d or -1, len(ws), s) for (d, _), ws, s in zip(texts, words, brute(words, order, min_count), strict=True))
    rows = [(d, t, 1, "x", 0.5) for d, t in texts]
    monkeypatch.setattr(lm_score, "CHUNK", 8)  # several chunks a task
    got = sorted((r.doc_id or -1, r.n_words, r.score) for r in lm_score.scores(spark.createDataFrame(rows, DOCS), order=order, min_count=min_count).collect())
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-6)


def test_empty_table(spark):
    assert lm_score.scores(spark.createDataFrame([], DOCS)).collect() == []
