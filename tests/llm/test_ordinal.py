import numpy as np

from kelpline.llm import ordinal as o

DOCS = "doc_id long, text string, __kept_before int, grade string"
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n=240):
    rng = np.random.default_rng(3)
    words = ["river", "stone", "cloud", "bread", "window", "garden", "paper", "light", "and", "the"]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, size=rng.integers(8, 60)))
        kind = i % 4
        if kind == 0:
            text.insert(int(rng.integers(0, len(text))), "vilest" + str(rng.choice(["ed", "ing", "er"])))
        elif kind == 1:
            text = [w + " |" for w in text]
        docs.append((i, " ".join(text), 1, "x"))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0, "clash"))
    return docs, labels


def test_held_out_grades(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    model = o.fit(frame, o.rated(spark.createDataFrame(labels[:160], LABELS)))
    assert (np.diff(model.thresholds) > 0).all()
    rows = {r.doc_id: r for r in o.score(frame, model).collect()}
    assert len(rows) == len(docs) and rows[0]["grade"] == "x"
    right = sum(rows[i]["__kept"] == (i % 4 > 1) for i in range(160, 240))
    assert right >= 78
    assert all(list(r["__tails"]) == sorted(r["__tails"], reverse=True) for r in rows.values())
    assert all(abs(sum(r["__tails"]) - r["__expected"]) < 1e-9 for r in rows.values())


def test_scores_equal_the_vectors_products(spark):
    docs, labels = corpus(120)
    docs += [(500, None, None, None), (501, "", None, None), (501, " \n", None, None), (None, "vilested river", None, None), (502, "river " * 30000, 1, "y")]
    frame = spark.createDataFrame(docs, DOCS)
    labels += [(None, 1, 0, ""), (3, 1, 1, ""), (4, None, None, ""), (9999, 0, 1, "")]
    model = o.fit(frame, o.rated(spark.createDataFrame(labels, LABELS)))
    got = sorted((r.doc_id or -1, r["__expected"]) for r in o.score(frame, model).collect())
    want = []
    for d, t, *_ in docs:
        idx, val = o.vector(t)
        want.append((d or -1, float(model.tails(np.array([(model.weights[idx].astype(float) * val).sum()])).sum())))
    assert np.allclose([x for _, x in got], [x for _, x in sorted(want)], atol=1e-4)


def test_rows_of_one_id_take_the_worst_rating(spark):
    rows = [(1, 1, 0, ""), (1, 0, 0, ""), (2, 1, 1, ""), (2, 1, 0, ""), (3, 1, None, ""), (4, None, None, ""), (None, 1, 1, "")]
    assert dict(o.rated(spark.createDataFrame(rows, LABELS)).collect()) == {1: 1, 2: 0, 3: 2}


def test_no_labels_and_no_rows(spark):
    none = o.fit(spark.createDataFrame([], DOCS), o.rated(spark.createDataFrame([], LABELS)))
    assert o.score(spark.createDataFrame([], DOCS), none).collect() == []
    assert o.score(spark.createDataFrame([(1, "a", 1, "")], DOCS), none).first()["__kept"]


def test_gradient():
    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(0, 40, 6)).astype(np.int32),) for _ in range(90)]
    rows = [(i, np.ones(len(i), dtype=np.float32) / 3) for (i,) in rows]
    y = np.array([0 if 3 in i else 1 if 7 in i else 2 for i, _ in rows])
    m = o.fit_arrays(rows, y)
    assert m.weights[3] < 0 and m.weights[7] < 0 and m.weights[3] < m.weights[7]


def test_fit_equals_a_fit_of_all_vectors_at_once(spark):
    """The distributed counts and the rows cut to telling features lose nothing."""
    docs, labels = corpus(200)
    frame = spark.createDataFrame(docs, DOCS)
    got = o.fit(frame, o.rated(spark.createDataFrame(labels, LABELS)))
    grades = [0 if t else 1 if not q else 2 for _, q, t, _ in labels]
    order = sorted(range(len(docs)), key=lambda k: grades[k])
    shares = np.bincount(grades, minlength=3) / len(grades)
    want = o.fit_arrays([o.vector(docs[k][1]) for k in order], np.array([grades[k] for k in order]), shares)
    assert (got.weights != 0).sum() == (want.weights != 0).sum() > 0
    assert np.allclose(got.weights, want.weights, rtol=0.02, atol=0.05) and np.allclose(got.thresholds, want.thresholds, atol=0.05)


def test_likelihood_is_at_its_minimum():
    """The fit against a plain likelihood, looped over rows, and steps around the solution."""
    rng = np.random.default_rng(5)
    rows = [(np.array([0, 1], dtype=np.int32)[: 1 + int(k % 2)], np.ones(1 + k % 2, dtype=np.float32)) for k in range(60)]
    y = np.array([int(rng.random() < (0.8 if k % 2 == 0 else 0.2)) * 2 for k in range(60)])
    y[::7] = 1
    wanted = np.zeros(1 << o.BITS, dtype=bool)
    wanted[[0, 1]] = True
    idx = np.concatenate([i for i, _ in rows])
    row = np.repeat(np.arange(60), [len(i) for i, _ in rows])
    prior = np.arange(1, o.GRADES) - o.GRADES / 2.0
    m = o._fit(row, idx, np.ones(len(idx)), y, None, wanted, prior)

    def cost(w0, w1, cut):
        total = 0.0
        for (i, _), g in zip(rows, y, strict=True):
            s = w0 + w1 * (1 in i)
            upper = 1.0 if g == 2 else 1 / (1 + np.exp(s - cut[g]))
            lower = 0.0 if g == 0 else 1 / (1 + np.exp(s - cut[g - 1]))
            total -= np.log(upper - lower) / len(rows)
        w = np.array([w0, w1]) / o.STRETCH
        return total + o.SHRINK / 2 * (w @ w) + o.PENALTY / 2 * ((cut - prior) @ (cut - prior))

    w0, w1, cut = float(m.weights[0]), float(m.weights[1]), m.thresholds
    least = cost(w0, w1, cut)
    for step in (-0.05, 0.05):
        assert cost(w0 + step, w1, cut) > least - 1e-6 and cost(w0, w1 + step, cut) > least - 1e-6
        assert cost(w0, w1, cut + [step, 0]) > least - 1e-6 and cost(w0, w1, cut + [0, step]) > least - 1e-6
