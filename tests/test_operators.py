"""De-duplication, dictionaries, matching, ranking, noise, reranker, holdout and committee on small frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kelpline.config import HoldoutConfig, NoiseConfig, RetrievalConfig
from kelpline.functions.embed import FunctionEmbedder, HashedNgrams, embedded
from kelpline.operators import dedupe, dictionary, holdout, match, noise, pairwise, panel, ranking

REF = "ref_id long, ref_pos long, code string, desc string"


@pytest.fixture
def ref(spark):
    rows = [(10, 0, "13-1.A", "ASSAULT WITH WEAPON"), (20, 1, "664/187", "MURDER ATTEMPT"), (30, 2, "", "THEFT OF MOTOR VEHICLE"), (40, 3, "9-Z", "DRIVING UNDER INFLUENCE")]
    return spark.createDataFrame(rows, REF)


def test_reference_keeps_the_newest_row_and_its_position(spark):
    rows = [("A", "ONE", "2021", 0), ("A", "ONE", "2023", 1), ("B", "TWO", "2022", 2), ("B", "TWO", "2022", 3), ("C", "X", "2024", 4)]
    got = dedupe.reference(spark.createDataFrame(rows, "chrg_code string, chrg_desc string, source_year string, load_seq long")).orderBy("ref_pos").collect()
    assert [(r.chrg_code, r.source_year, r.load_seq, r.ref_pos) for r in got] == [("B", "2022", 3, 0), ("A", "2023", 1, 1)]


def test_positions_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("x", F.xxhash64("id"))
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = [r.id for r in dedupe.with_position(df, "pos", "x").orderBy("pos").collect()]
        assert got == [r.id for r in df.orderBy("x").collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_conflicts_count_nulls_as_a_value(spark):
    rows = [("A", 1, 0, 1, None), ("A", 2, 1, 1, None), ("B", 1, 2, 0, 1), ("B", 2, 3, None, 1), ("", 1, 4, 0, 0)]
    df = spark.createDataFrame(rows, "chrg_code string, source_year int, ref_pos int, chrg_type_a int, chrg_type_b int")
    got = {r.chrg_code: (r.conflict, r.ref_pos) for r in dedupe.code_groups(df, ["chrg_type_a", "chrg_type_b"]).collect()}
    assert got == {"A": (False, 1), "B": (True, 3)}


def test_derivation_order(spark):
    d = spark.createDataFrame([("187", "HOMICIDE"), ("13", "FRAUD"), ("13.5", "OTHER")], "dict_code string, dict_desc string")
    codes = ["664/187", "664/999", "13(A1)", "13ABC", "13.9", "13 VC/2", "187", "zzz", None, "13.5A"]
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string")
    got = {r.i: r.derived_desc for r in dictionary.derive(df, d, "i", "code").collect()}
    assert [got[k] for k in range(len(codes))] == ["ATT:HOMICIDE", "", "FRAUD", "FRAUD", "FRAUD", "FRAUD", "", "", "", "OTHER"]


def keyword(texts):
    return [[float("ASSAULT" in t), float("MURDER" in t), float("THEFT" in t)] for t in texts]


def test_cascade_states(spark, ref):
    embedder = FunctionEmbedder(lambda: keyword)
    ref = ref.withColumn("vector", embedded(embedder, F.col("desc")))
    rows = [(1, "13-1.a", "assault with weapon"), (2, "X", "ASSAULT WITH WEAPON"), (3, "X", "WEAPON ASSAULT WITH"), (4, "X", "MURDER PLOT ABROAD"), (5, "X", "NOTHING ALIKE HERE")]
    q = spark.createDataFrame(rows, "query_id long, code string, desc string").withColumn("vector", embedded(embedder, F.upper("desc")))
    got = {r.query_id: (r.ref_id, r.method, r.needs_review) for r in match.cascade(q, ref).collect()}
    assert got == {1: (10, "exact", False), 2: (10, "fuzzy", False), 3: (10, "fuzzy", False), 4: (20, "embedding", False), 5: (10, "embedding", True)}
    by_text = {r.query_id: r.method for r in match.cascade(q, ref, by_code=False).collect()}
    assert by_text[2] == "exact"


def test_fuzzy_equals_all_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ABC") for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 4))) for _ in range(60)]
    ref = spark.createDataFrame([(i, i, "", t) for i, t in enumerate(texts[:30])], REF)
    q = spark.createDataFrame([(i, "", t) for i, t in enumerate(texts[30:])], "query_id long, code string, desc string")
    from tests.test_text import plain_ratio

    norm = lambda t: " ".join(sorted(t.upper().split()))
    for threshold in (60.0, 90.0):
        want = {}
        for i, t in enumerate(texts[30:]):
            best = max(((plain_ratio(norm(t), norm(r)), -j) for j, r in enumerate(texts[:30])))
            if best[0] >= threshold:
                want[i] = -best[1]
        assert {r.query_id: r.ref_id for r in match.fuzzy(q, ref, threshold).collect()} == want


def test_ranking_fixture_and_ties(spark, ref):
    q = spark.createDataFrame([(1, "13 1 A", "ASSLT W/ WEAPON", 10), (2, "", "MTR VEHICLE THEFT", 30)], "query_id long, code string, desc string, target long")
    s, places, negatives = ranking.evaluate(q, ref)
    assert s.first().asDict() == {"n_queries": 2, "mrr": 1.0, "mean_rank": 1.0, "recall_at_1": 1.0, "recall_at_3": 1.0, "recall_at_5": 1.0}
    assert all(r.ref_id != r.target for r in negatives.collect()) and negatives.count() == 6
    twins = spark.createDataFrame([(5, 0, "", "SAME TEXT"), (6, 1, "", "SAME TEXT")], REF)
    one = spark.createDataFrame([(1, "", "SAME TEXT", 6)], "query_id long, code string, desc string, target long")
    assert ranking.evaluate(one, twins, RetrievalConfig(top_ks=(1, 2)))[0].first().asDict() == {"n_queries": 1, "mrr": 0.5, "mean_rank": 2.0, "recall_at_1": 0.0, "recall_at_2": 1.0}
    with pytest.raises(ValueError, match="not in the reference"):
        ranking.evaluate(one, ref)
    none = ranking.evaluate(one.where("false"), ref)[0].first()
    assert none.n_queries == 0 and none.mrr == 0.0


def test_blank_texts_rank_by_code(spark):
    blank = spark.createDataFrame([(1, 0, "A-1", None), (2, 1, "B-2", ""), (3, 2, None, "")], REF)
    q = spark.createDataFrame([(1, "B2", "")], "query_id long, code string, desc string")
    top = ranking.rank_candidates(q, blank).where("rank = 1").first()
    assert top.ref_id == 2 and top.code_sim == 1.0 and top.tfidf == 0.0


def test_noise(spark, ref):
    ref = ref.withColumn("source_year", F.lit(2024)).unionByName(spark.createDataFrame([(50, 4, None, " \t", 2025), (60, 5, None, "LATE  OFFENCE\tROW", 2025)], REF + ", source_year int"))
    a, b = noise.generate(ref, NoiseConfig(3)), noise.generate(ref.repartition(5), NoiseConfig(3))
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 15
    assert noise.keeps_code(a).count() == 0
    assert {r.ref_desc for r in a.where("target = 60").collect()} == {"LATE OFFENCE ROW"}
    assert noise.generate(ref, NoiseConfig(2), [2025]).count() == 8
    assert {"abbreviation"} <= {t for r in a.collect() for t in r.transformations.split("|")}
    with pytest.raises(ValueError):
        noise.generate(ref.drop("source_year"), exclude_years=[2025])


def test_reranker_learns_to_trust_the_code(spark):
    words = ["ARSON FIRST DEGREE", "BURGLARY AT NIGHT", "CARRYING A KNIFE", "DRUG SALE NEAR SCHOOL", "ESCAPE FROM JAIL", "FORGERY OF CHECKS"]
    ref = spark.createDataFrame([(i, i, f"{i}{i}-{i}", w) for i, w in enumerate(words)], REF)
    q = spark.createDataFrame([(i, f"{i}{i} {i}", words[(i + 1) % 6], i) for i in range(6)], "query_id long, code string, desc string, target long")
    s, places, model = pairwise.evaluate(q, ref, test_size=0.34)
    r = s.first()
    assert (r.n_queries, r.baseline_recall_at_1, r.reranked_recall_at_1) == (3, 0.0, 1.0) and model.weights["code_sim"] > 0
    examples = pairwise.pair_examples(ranking.rank_candidates(q, ref))
    assert examples.count() == 6 * 5 * 2 and examples.agg(F.sum("label")).first()[0] == 30
    train, test = pairwise.grouped_split(q.unionAll(q.withColumn("query_id", F.col("query_id") + 100)), test_size=0.34)
    assert not {r.target for r in train.collect()} & {r.target for r in test.collect()} and train.count() + test.count() == 12


def test_holdout(spark):
    rows = [(10, 0, "A-1", "ASSAULT WITH WEAPON", 2021), (20, 1, "B-2", "THEFT OF VEHICLE", 2022), (30, 2, "C-3", "DRIVING UNDER INFLUENCE", 2023), (40, 3, "D-4", "DOMESTIC VIOLENCE", 2024), (50, 4, "E-5", "LATER ROW", 2025), (60, 5, "F-6", "MUCH LATER ROW", 2026)]
    history = spark.createDataFrame(rows, REF + ", source_year int")
    q = spark.createDataFrame([("a", "A 1", "ASSLT WITH WEAPON", 2025, 10), ("b", "B.2", "THEFT VEHICLE", 2025, 20), ("c", "Z", "NEW THING", 2025, None), ("d", "E5", "LATER ROW", 2025, 50)], "query_id string, code string, desc string, source_year int, target long")
    cfg = HoldoutConfig(2025, variants=2)
    assert sorted(r.ref_id for r in holdout.cut(history, cfg).collect()) == [10, 20, 30, 40]
    s, judged, _ = holdout.evaluate(history, q, cfg)
    r = s.first()
    assert (r.n_history, r.n_training, r.n_synthetic, r.n_mapped, r.n_novel, r.mapped_coverage, r.reviews) == (6, 4, 8, 2, 2, 0.5, 0)
    assert holdout.acceptance(judged, 1e9).first().review_rate == 1.0
    assert r.reranked_top1 == 1.0
    with pytest.raises(ValueError, match="other years"):
        holdout.check_queries(q.withColumn("source_year", F.lit(2024)), cfg)
    with pytest.raises(ValueError, match="numeric year"):
        holdout.cut(history.withColumn("source_year", F.lit("x")), cfg)


def test_single_candidate_margin_is_infinite(spark):
    one = spark.createDataFrame([("q", 1, 0.4, 1, 1)], "query_id string, ref_id long, rerank_score double, rank int, new_rank int")
    assert math.isinf(holdout.margins(one).first().margin)


def test_consensus(spark):
    votes = [("q", "a", str(k), v, p) for k, (v, p) in enumerate([(1, 0.95), (1, 0.9), (1, 0.92), (1, 0.9), (0, 0.8)])]
    votes += [("q", "b", str(k), v, 0.6) for k, v in enumerate([1, 1, 0, 0])]  # an even split votes 0
    votes += [("q", "c", str(k), 1, 0.7) for k in range(3)]
    v = spark.createDataFrame(votes, "query_id string, attr string, model string, vote int, probability double")
    m = spark.createDataFrame([("q", 0, None, 0), ("r", 1, 1, 1)], "query_id string, a int, b int, c int")
    got = {r.query_id: r for r in panel.overridden(m, panel.resolve(m, v, ["a", "b", "c"]), ["a", "b", "c"]).collect()}
    q = got["q"]
    assert (q.disagreements, q.resolved, q.unresolved, q.confidence, q.a, q.b, q.c) == (2, 1, True, 0.7, 1, None, 0)
    assert (got["r"].disagreements, got["r"].confidence, got["r"].unresolved) == (0, 1.0, False)


def test_panel_gates_and_agreement(spark):
    rows = [(i, [float(i % 2), float(i % 3 == 0), 1.0], str(i % 2), "x" if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "query_id long, vector array<double>, chrg_type_a string, chrg_type_b string")
    fitted = panel.train(df, ["chrg_type_a", "chrg_type_b"], 5, ("svm", "bayes"))
    assert list(fitted) == ["chrg_type_a"] and set(fitted["chrg_type_a"]) == {"svm", "bayes"}
    assert panel.train(df, ["chrg_type_a"], 99) == {}
    votes = panel.votes(df, fitted)
    assert votes.count() == 80 and votes.where("vote <> query_id % 2").count() == 0
    near = spark.createDataFrame([(1, 5, 0, 0.9, "1", None), (1, 6, 1, 0.9, "0", "1")], "query_id long, ref_id long, ref_pos long, cosine double, chrg_type_a string, chrg_type_b string")
    profiles = spark.createDataFrame([(1, "chrg_type_a", 0.8), (1, "chrg_type_b", 0.3)], "query_id long, attr string, p double")
    agreed = {r.ref_id: round(r.agreement, 6) for r in panel.agreement(near, profiles, ["chrg_type_a", "chrg_type_b"]).collect()}
    assert agreed == {5: 0.75, 6: 0.25}
    best = panel.rerank(near, panel.agreement(near, profiles, ["chrg_type_a", "chrg_type_b"])).first()
    assert best.ref_id == 5 and best.margin == pytest.approx(0.2)


def test_hashed_embedder(spark):
    df = spark.createDataFrame([("ASSAULT",), ("",), (None,)], "t string").select(embedded(HashedNgrams(64), F.col("t")).alias("v"))
    norms = [sum(x * x for x in r.v) for r in df.collect()]
    assert norms[0] == pytest.approx(1.0) and norms[1:] == [0.0, 0.0]
