import itertools
import random

from kelpline.llm import packing, registry

from tests.oracle import same

DOCS = "doc_id long, text string, chunk int, bucket string"


def test_bounds_match_all_choices():
    rng = random.Random(1)
    for _ in range(40):
        hist = {rng.randint(0, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k = rng.randint(1, 4)
        ends = packing.bounds(hist, k)
        pad = lambda e: sum(n * (min(x for x in e if x >= v) - v) for v, n in hist.items())
        top = max(hist)
        best = min(pad([*c, top]) for c in itertools.combinations(sorted(hist)[:-1], min(k, len(hist)) - 1))
        assert ends[-1] == top and len(ends) == min(k, len(hist)) and pad(ends) == best


def test_query_matches_sql(spark, sf):
    assert same(packing.query(spark, sf), registry.ORACLES["op2_packing"], sf) >= 200


def test_edge_rows(spark, monkeypatch):
    rows = [(1, None, 1, ""), (2, "", 1, ""), (3, "w " * 5000, 1, ""), (None, "a b", None, None), (4, "a", 1, ""), (4, "a", 1, "")]
    out = packing.pack(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.n_tokens for r in out) == 5000 + 2 + 2 and len(out) == 8
    assert all(r.n_tokens <= r.bucket_len for r in out)
    assert len({(r.bucket, r.batch, r.slot) for r in out}) == len(out)
    batches = {}
    for r in out:
        batches.setdefault((r.bucket, r.batch), []).append(r.bucket_len)
    assert all(sum(v) <= packing.TOKEN_BUDGET for v in batches.values())
    assert packing.pack(spark.createDataFrame([], DOCS)).collect() == []
