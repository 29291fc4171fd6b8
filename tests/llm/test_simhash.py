import numpy as np
import pytest
from pyspark.sql import types as T

from kelpline.llm import simhash

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType())]
)


def brute(rows):
    """Component per row by comparing every pair."""
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.BUDGET:
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(d, fps[i], ids.get(find(i))) for i, (d, _) in enumerate(rows)]


def got(spark, rows):
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    return [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect()]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_fingerprint_by_definition():
    import xxhash

    text = "The QUICK\tbrown fox  jumps\x0bover ÄÖ the"
    words = "the quick brown fox jumps over ÄÖ the".split(" ")
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b"") == simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_components_match_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(None, docs[0].text), (7001, None), (7000, ""), (7000, ""), (None, "x y")]
    assert sorted(got(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_every_close_pair_shares_a_viable_key():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        a = int(rng.integers(0, 2**63)) * 2 + 1
        x = sum(1 << int(b) for b in rng.choice(64, size=rng.integers(1, 5), replace=False))
        assert any(
            not x & mask and simhash._viable(np.array([x], dtype=np.uint64), np.array([start]))[0] for start, mask in simhash.KEYS
        ), (a, x)


@pytest.mark.parametrize("block", [3, 40])
def test_large_groups_are_dealt_in_blocks(spark, monkeypatch, block):
    """A chain of fingerprints that share keys, with groups above the block size."""
    rng = np.random.default_rng(1)
    base, fps = 0x123456789ABCDEF0, set()
    for _ in range(120):
        fps.add(base ^ sum(1 << int(b) for b in rng.choice(64, size=3, replace=False)))
    fps = sorted(fps)
    keys, kinds, values = [], [], []
    for k, (_, mask) in enumerate(simhash.KEYS):
        for f in fps:
            keys.append(hash((k, f & mask)) & (2**62 - 1))
            kinds.append(k)
            values.append(f)
    monkeypatch.setattr(simhash, "BLOCK", block)
    order = np.argsort(keys, kind="stable")
    k, g, f = np.array(keys)[order], np.array(kinds, dtype=np.int32)[order], np.array(values, dtype=np.uint64)[order]
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_arrays([pa.array(k[i : i + 50]), pa.array(g[i : i + 50]), pa.array(f[i : i + 50].view(np.int64))], names=["key", "kind", "fp"])
        for i in range(0, len(k), 50)
    ]
    out = pa.Table.from_batches(list(simhash._links(iter(batches))), schema=simhash._LINKS).to_pylist()
    edges = {(r["a"], r["b"]) for r in out if r["key"] is None}
    groups = {}
    for r in out:
        if r["key"] is not None:
            groups.setdefault(r["key"], []).append(r)
    for rows in groups.values():
        assert len(rows) > block and max(r["block"] for r in rows) == (len(rows) - 1) // block
        for lo in range((len(rows) - 1) // block + 1):
            for hi in range(lo, (len(rows) - 1) // block + 1):
                part = pa.table({"a": pa.array([r["a"] for r in rows if r["block"] in (lo, hi)], pa.int64()), "kind": pa.array([r["kind"] for r in rows if r["block"] in (lo, hi)], pa.int32())})
                t = simhash._block_links(part)
                edges |= set(zip(t["a"].to_pylist(), t["b"].to_pylist(), strict=True))
    signed = [int(np.array([x], dtype=np.uint64).view(np.int64)[0]) for x in fps]
    parent = {x: x for x in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        parent[find(a)] = find(b)
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 4:
                assert find(signed[i]) == find(signed[j])
