"""Each stage against a plain version of its decision, on the rows that the stage before kept."""

import corpus_pipeline as p
from kelpline.llm import decontam, ordinal, packing, simhash
from kelpline.llm.common import table, written
from tests.llm.test_decontam import words
from tests.llm.test_pii import brute
from tests.llm.test_jaccard import brute as brute_components


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    before = rows(docs)
    assert [name for name, _ in p.STAGES] == ["quality classifier", "near duplicates", "decontamination", "personal data", "packing"]

    kept = written(p.quality(spark, docs, sf), "t")
    model = ordinal.fit(docs, ordinal.rated(table(spark, sf, "labels")))
    good = {r.doc_id for r in ordinal.score(docs, model).collect() if r["__tails"][-1] >= ordinal.KEEP}
    assert set(rows(kept)) == good and kept.columns == list(p.COLUMNS)

    once = written(p.near_duplicates(spark, kept, sf), "t")
    parts = brute_components([(r.doc_id, r.text) for r in rows(kept).values()])
    assert set(rows(once)) == {c for _, c in parts}

    clean = written(p.decontaminate(spark, once, sf), "t")
    items = [words(r.text) for r in table(spark, sf, "benchmark").collect()]

    def leaks(text):
        w = words(text)
        n = {}
        import numpy as np

        number = lambda s: np.array([n.setdefault(v, len(n)) for v in s])
        return any(decontam.align(number(q), number(w)) >= decontam.THRESHOLD * 2 * len(q) for q in items)

    assert set(rows(clean)) == {i for i, r in rows(once).items() if not leaks(r.text)}

    safe = written(p.personal_data(spark, clean, sf), "t")
    after = rows(safe)
    assert set(after) == set(rows(clean)) and safe.columns == list(p.COLUMNS)
    for i, r in after.items():
        assert not brute(r.text) and r.n_chars == len(r.text)
        if not brute(before[i].text):
            assert r.text == before[i].text

    packed = p.pack(spark, safe, sf).collect()
    sizes = {}
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.n_tokens
        assert r.n_tokens <= r.bucket_len <= packing.MAX_TOKENS
    assert sizes == {i: len(r.text.split()) for i, r in after.items()}
    assert sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, packed))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, tmp_path, rows, extra=()):
    """A folder of input tables with these documents."""
    frame = spark.createDataFrame([(*r, *(1 for _ in extra)) for r in rows], SCHEMA + "".join(f", {c} int" for c in extra))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)] * bool(rows), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "what is the tallest mountain of the northern range")] * bool(rows), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_empty_tables(spark, tmp_path):
    assert p.run(spark, made(spark, tmp_path, [])).collect() == []


def test_clashing_columns_nulls_and_a_very_long_text(spark, tmp_path):
    long = " ".join(f"w{k % 7001}x{k % 13}" for k in range(120_000))
    rows = [(1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (None, "x", None, None, None), (3, None, None, None, None), (4, long, "en", "s", len(long)), (5, "", "en", "s", 0)]
    out = p.run(spark, made(spark, tmp_path, rows, extra=("key", "size", "item_id", "component_id", "score"))).collect()
    sizes = {}
    for r in out:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.n_tokens
    assert sizes == {1: 6, None: 1, 3: 0, 4: 120_000}


def test_repeated_rows_and_rows_without_id(spark):
    data = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (None, "x", None, None, None), (3, None, None, None, None)]
    out = p.near_duplicates(spark, spark.createDataFrame(data, SCHEMA), "").collect()
    assert sorted((r.doc_id or -1) for r in out) == [-1, 1, 3]
    assert simhash.fingerprint(None) == 0
