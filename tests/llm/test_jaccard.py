import random

import corpus_pipeline as p
from kelpline.llm import jaccard
from kelpline.llm.simhash import majority

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Component per row by comparing every pair."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)


def edited(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def test_components_match_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in docs] + [(None, docs[0].text), (7001, None), (7000, ""), (None, "x y"), (7002, "X  y")]
    for k in range(12):
        text = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([8, 40, 200]))]
        rows += [(8000 + 10 * k + j, edited(rng, text, min(j * len(text) // 60, len(text)))) for j in range(6)]
    assert got(spark, rows) == brute(rows)


def test_long_groups(spark):
    """Near copies in groups longer than SHORT, some linked only through others."""
    rng = random.Random(5)
    text = [f"w{k}" for k in range(120)]
    rows, words = [], text
    for k in range(150):
        rows.append((k, edited(rng, text, rng.randrange(1, 6))))
    for k in range(150, 200):  # each differs from the one before by one word
        words = edited(rng, words, 1).split()
        rows.append((k, " ".join(words)))
    assert len(rows) > jaccard.SHORT
    assert got(spark, rows) == brute(rows)


def test_edited_copies_leave_the_stage(spark):
    rng = random.Random(1)
    text = [f"w{k}" for k in range(150)]
    rows = [(1, " ".join(text)), (2, edited(rng, text, 2)), (3, edited(rng, text, 60))]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA)
    assert brute(rows) == [(1, 1), (2, 1), (3, 3)]
    assert sorted(r.doc_id for r in p.near_duplicates(spark, df, "").collect()) == [1, 3]


def test_empty_table(spark):
    assert got(spark, []) == []


def checked(monkeypatch):
    """A list that gets the number of pairs of each search and of its links."""
    seen, links = [], jaccard._links

    def counted(pairs, *rest):
        out = links(pairs, *rest)
        seen.append((pairs.selectExpr("least(a, b)", "greatest(a, b)").distinct().count(), out.count()))
        return out

    monkeypatch.setattr(jaccard, "_links", counted)
    return seen


def test_pairs_of_a_large_group_grow_with_its_rows(spark, monkeypatch):
    """Near copies that their pivots leave in many components."""
    rng = random.Random(8)
    text = [f"w{k}" for k in range(150)]
    rows = [(k, edited(rng, text, rng.randrange(1, 5))) for k in range(500)]
    seen = checked(monkeypatch)
    assert got(spark, rows) == brute(rows)
    assert sum(n for n, _ in seen) <= 40 * len(rows)


def test_turns_leave_out_no_pair(spark, monkeypatch):
    """Many possible pairs a row, few of them similar: further turns until none is left out."""
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    monkeypatch.setattr(jaccard, "LOOK", 2)
    monkeypatch.setattr(jaccard, "MORE", 2)
    rng = random.Random(6)
    text = [f"w{k}" for k in range(100)]
    rows = [(k, edited(rng, text, rng.choice([2, 3, 4, 5]))) for k in range(80)]
    seen = checked(monkeypatch)
    assert got(spark, rows) == brute(rows) and len(seen) > 3


def test_fingerprints_make_the_first_links(spark, monkeypatch):
    rng = random.Random(2)
    text = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(text)), (2, " ".join(text[:-1])), (3, edited(rng, text, 8)), (4, "quite another text of its own words")]
    fps = [int(majority(jaccard.shingles(t.encode()))) for _, t in rows]
    assert (fps[0] ^ fps[1]).bit_count() <= 4 < (fps[0] ^ fps[2]).bit_count()
    seen = checked(monkeypatch)
    assert got(spark, rows) == brute(rows) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    assert seen[0] == (1, 1)


def test_sets_of_few_pairs_at_once(spark, monkeypatch):
    """Sets are kilobytes a pair: 10,000 pairs in a batch are too many for several tasks of an executor."""
    check, before = jaccard._check, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def watched(batches):
        def seen():
            for batch in batches:
                assert batch.num_rows <= 3
                yield batch

        return check(seen())

    monkeypatch.setattr(jaccard, "_check", watched)
    monkeypatch.setattr(jaccard, "CHECKED", 3)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*words, f"end{k}"])) for k in range(30)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(k, 0) for k in range(30)]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
