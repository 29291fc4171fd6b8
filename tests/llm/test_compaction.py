import pytest
from pyspark.sql import functions as F

from kelpline.llm import compaction as c

ROWS = "doc_id long, text string, path string, bytes long, tier array<int>"


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(c, "MIN_BYTES", 1 << 10)
    monkeypatch.setattr(c, "TARGET_BYTES", 8 << 10)
    monkeypatch.setattr(c, "SHARD_ROWS", 40)
    return c.ShardStore(spark, f"file://{tmp_path}/store")


def rows(spark, lo, hi):
    return spark.createDataFrame([(i if i % 7 else None, None if i % 5 == 0 else f"text {i} " * 3, "clash", i, [i]) for i in range(lo, hi)], ROWS).repartition(3)


def plain(df):
    return sorted((repr(tuple(r[k] for k in ("doc_id", "text", "path", "bytes", "tier"))) for r in df.collect()))


def test_life_of_a_store(spark, store):
    assert store.version() == 0 and store.read(0).count() == 0
    for k in range(5):
        assert store.append(rows(spark, 100 * k, 100 * k + 100)) == k + 1
    everything = plain(rows(spark, 0, 500))
    assert plain(store.read()) == everything and plain(store.read(2)) == plain(rows(spark, 0, 200))
    before = store.manifest().count()
    assert store.compact() >= 1
    after = store.manifest().collect()
    assert len(after) < before and sum(r.n_rows for r in after) == 500
    small = [r for r in after if r.bytes < c.TARGET_BYTES // 2]
    assert all(sum(r.tier == t for r in small) < c.FANOUT for t in {r.tier for r in small})
    assert plain(store.read()) == everything
    assert plain(store.read(3)) == plain(rows(spark, 0, 300))  # old versions stay readable
    assert store.vacuum() > 0 and plain(store.read()) == everything
    assert store.compact() == 0 and store.vacuum() == 0


def test_a_second_writer_conflicts(spark, store):
    store.append(rows(spark, 0, 10))
    with pytest.raises(c.Conflict):
        store._commit(store.manifest(), 1)
    assert store.version() == 1 and store.read().count() == 10


def test_uncommitted_files_and_empty_arrivals(spark, store):
    store.append(rows(spark, 0, 10))
    rows(spark, 10, 20).write.parquet(f"{store.path}/data/lost")
    assert store.read().count() == 10
    store.append(rows(spark, 0, 0))
    assert store.version() == 2 and store.read().count() == 10
    assert store.vacuum() >= 1 and store.read().count() == 10


def test_arrival_batches_commit_in_order(spark, store):
    df = rows(spark, 0, 90).withColumn("batch", F.col("bytes") % 3)
    assert store.append(df, "batch") == 3
    assert [store.read(v).count() for v in (1, 2, 3)] == [30, 60, 90] and "batch" not in store.read().columns


def test_query(spark, sf):
    got = c.query(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs)
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard_id, []).append(r.shard_rows)
    assert all(len(v) == v[0] for v in sizes.values())


def test_writers_that_meet_keep_all_rows_and_unique_numbers(spark, store, monkeypatch):
    """Another writer commits between a writer's reading of the version and its commit."""
    store.append(rows(spark, 0, 50))
    other, real, done = c.ShardStore(spark, store.path), c.ShardStore._commit, []

    def late(self, manifest, version):
        if self is store and not done:
            done.append(other.append(rows(spark, 50, 100)))
        return real(self, manifest, version)

    monkeypatch.setattr(c.ShardStore, "_commit", late)
    assert store.append(rows(spark, 100, 150)) == 3
    ids = [r.shard_id for r in store.manifest().collect()]
    assert len(ids) == len(set(ids)) and plain(store.read()) == plain(rows(spark, 0, 150))


def test_merges_that_meet_keep_all_rows(spark, store, monkeypatch):
    for k in range(4):
        store.append(rows(spark, 100 * k, 100 * k + 100))
    other, real, done = c.ShardStore(spark, store.path), c.ShardStore._commit, []

    def late(self, manifest, version):
        if self is store and not done:
            done.append(other.compact())
        return real(self, manifest, version)

    monkeypatch.setattr(c.ShardStore, "_commit", late)
    store.compact()
    assert done and plain(store.read()) == plain(rows(spark, 0, 400))


def test_vacuum_leaves_a_writer_at_work_alone(spark, store):
    store.append(rows(spark, 0, 10))
    name = store._folder()
    rows(spark, 10, 20).write.parquet(f"{store.path}/data/{name}")
    assert store.vacuum() == 0
    store._done(name)
    assert store.vacuum() >= 1 and store.read().count() == 10


def test_very_long_texts(spark, store):
    df = spark.createDataFrame([(1, "x" * 3_000_000, "p", 1, [1]), (2, "", None, None, None)], ROWS)
    store.append(df)
    assert plain(store.read()) == plain(df)
