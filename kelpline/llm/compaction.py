"""Sharding by size-tiered compaction over immutable Parquet shards and versioned manifests.

Native: Spark's readers and writers move all rows; the driver handles file names
and sizes only, at most STEP_FILES of them at a time.

``append`` writes arrivals as small shards (files) and commits a manifest that
names them. ``compact`` looks at the tiers of the manifest: a shard is in tier t if
its size lies between MIN_BYTES * FANOUT^t and the next power. A tier below
TARGET_BYTES with at least FANOUT shards is merged into files of about
TARGET_BYTES: its shards are read, coalesced without a shuffle, as sizes in a
tier are alike, and written; then a new manifest replaces them. ``vacuum`` removes
files that the kept versions do not name.

A manifest is a table (shard_id, arrival, path, bytes, n_rows, tier) under a name of
its own. A version is a file that names its manifest; it is created at once and
for one writer only (``common.publish``), and readers follow the largest. A writer
that comes second starts again from the version that won: appended shards take
new numbers, a merge whose shards another merge has taken is dropped. A job that
dies before its commit leaves unnamed files, which no reader sees. Writers note the
folders that they fill, so vacuum leaves those alone for NOTE_SECONDS and removes
other unnamed files. Writers use Spark's commit protocol, so lost or repeated tasks
leave nothing behind.

Rows are kept as they are: nulls, repeated rows and any columns. An empty arrival
commits a version that names no new shard.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import _hadoop_path, content, exists, publish, remove, scratch, small_side, table

ARRIVALS = 6
SHARD_ROWS = 20_000
MIN_BYTES = 1 << 20
FANOUT = 4
TARGET_BYTES = 64 << 20
STEP_FILES = 10_000
#: How long a writer may take before vacuum holds its folder to be abandoned.
NOTE_SECONDS = 7 * 24 * 3600

MANIFEST = "shard_id long, arrival long, path string, bytes long, n_rows long, tier int"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- versions

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        names = [n for n, _ in self._listed("versions")]
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)

    def _listed(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in milliseconds) of what stands in a folder."""
        where, fs = _hadoop_path(self.spark, f"{self.path}/{folder}")
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(where)] if fs.exists(where) else []

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        name = content(self.spark, f"{self.path}/versions/v{version:09d}")
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{name}")

    def _commit(self, rows: DataFrame, version: int) -> None:
        name = uuid.uuid4().hex
        rows.coalesce(8).write.parquet(f"{self.path}/manifests/{name}")
        if not publish(self.spark, name, f"{self.path}/versions/v{version:09d}"):
            remove(self.spark, f"{self.path}/manifests/{name}")
            raise Conflict(f"version {version} is there already")

    def _add(self, shards: list[tuple]) -> None:
        """Commits shards (without numbers) on top of the newest version, again after each conflict."""
        while True:
            version = self.version()
            base = self.manifest(version)
            start = base.agg(F.coalesce(F.max("shard_id"), F.lit(-1))).first()[0] + 1
            fresh = self.spark.createDataFrame([(start + k, *r) for k, r in enumerate(shards)], MANIFEST)
            try:
                return self._commit(base.unionByName(fresh), version + 1)
            except Conflict:
                continue

    def _folder(self) -> str:
        """A new data folder, noted as being written."""
        name = uuid.uuid4().hex
        publish(self.spark, "", f"{self.path}/notes/{name}")
        return name

    def _done(self, name: str) -> None:
        remove(self.spark, f"{self.path}/notes/{name}")

    def _schema(self, df: DataFrame | None = None) -> StructType | None:
        place = f"{self.path}/schema"
        if df is not None and not exists(self.spark, place):
            self.spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(place)
        if not exists(self.spark, place):
            return None
        import json

        return StructType.fromJson(json.loads(self.spark.read.text(place).first()[0]))

    def _shards(self, folder: str, arrival) -> DataFrame:
        """The files of a folder as manifest rows without ids."""
        files = self.spark.read.option("recursiveFileLookup", True).schema(self._schema()).parquet(folder)
        named = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        grouped = named.groupBy("path", "bytes").agg(F.count("*").alias("n_rows"))
        tier = F.greatest(F.floor(F.log(F.col("bytes") / MIN_BYTES) / F.log(F.lit(float(FANOUT)))), F.lit(0)).cast("int")
        return grouped.select(arrival.cast("long").alias("arrival"), "path", "bytes", "n_rows", tier.alias("tier"))

    def _found(self, rows: DataFrame) -> list[tuple]:
        """At most STEP_FILES or one write's files: (arrival, path, ...) in the order of arrival and path."""
        return sorted((tuple(r) for r in rows.collect()), key=lambda r: r[:2])

    # -- writing

    def append(self, df: DataFrame, arrival_col: str | None = None) -> int:
        """Writes arrivals as small shards: one commit, or one per value of ``arrival_col`` (dropped), in order."""
        data = df.drop(arrival_col) if arrival_col else df
        self._schema(data)
        name = self._folder()
        folder = f"{self.path}/data/{name}"
        writer = (df.withColumnRenamed(arrival_col, "__arrival") if arrival_col else df).write.option("maxRecordsPerFile", SHARD_ROWS).option("compression", "zstd")
        (writer.partitionBy("__arrival") if arrival_col else writer).parquet(folder)
        number = F.coalesce(F.regexp_extract("path", r"/__arrival=(\d+)/", 1).try_cast("long"), F.lit(0)) if arrival_col else F.lit(self.version() + 1)
        rows = self._found(self._shards(folder, number))
        for value in sorted({r[0] for r in rows}) or [None]:
            self._add([r for r in rows if r[0] == value])
        self._done(name)
        return self.version()

    def compact(self) -> int:
        """Merges tiers until none below the target has FANOUT shards; the number of merges."""
        merges = 0
        while True:
            version, now = self.version(), self.manifest()
            small = F.col("bytes") < TARGET_BYTES // 2
            tiers = now.where(small).groupBy("tier").agg(F.count("*").alias("n")).where(F.col("n") >= FANOUT)
            ready = tiers.orderBy("tier").limit(1).collect()
            if not ready:
                return merges
            step = now.where(small & (F.col("tier") == ready[0].tier)).orderBy("shard_id").limit(STEP_FILES).collect()
            files = -(-sum(r.bytes for r in step) // TARGET_BYTES)
            name = self._folder()
            folder = f"{self.path}/data/{name}"
            rows = self.spark.read.schema(self._schema()).parquet(*[r.path for r in step])
            rows.coalesce(int(files)).write.option("compression", "zstd").parquet(folder)
            merged = self._found(self._shards(folder, F.lit(max(r.arrival for r in step))))
            if sum(r[3] for r in merged) != sum(r.n_rows for r in step):
                raise RuntimeError("a merge changed the number of rows")
            replaced = self._replace([r.path for r in step], merged, version)
            self._done(name)
            if not replaced:
                continue
            merges += 1
            if len(merged) >= len(step):
                return merges

    def _replace(self, paths: list[str], merged: list[tuple], version: int) -> bool:
        """Commits ``merged`` in place of the shards at ``paths``; false if another merge took some of those first."""
        gone = F.broadcast(self.spark.createDataFrame([(p,) for p in paths], "path string"))  # at most STEP_FILES names
        while True:
            now = self.manifest(version)
            if now.join(gone, "path", "left_semi").count() != len(paths):
                return False
            start = now.agg(F.max("shard_id")).first()[0] + 1
            fresh = self.spark.createDataFrame([(start + k, *r) for k, r in enumerate(merged)], MANIFEST)
            try:
                self._commit(now.join(gone, "path", "left_anti").unionByName(fresh), version + 1)
                return True
            except Conflict:
                version = self.version()

    def vacuum(self, keep: int = 1) -> int:
        """Removes data files that neither the newest ``keep`` versions name nor a writer is filling; how many.

        Files are listed first, then the notes, then the versions: a file whose note
        is gone by then was committed before the versions are read.
        """
        where, fs = _hadoop_path(self.spark, f"{self.path}/data")
        if not fs.exists(where):
            return 0
        listed, files = fs.listFiles(where, True), []
        while listed.hasNext():
            files.append(listed.next().getPath())
        oldest = (time.time() - NOTE_SECONDS) * 1000
        busy = {n for n, changed in self._listed("notes") if changed >= oldest}
        version = self.version()
        named = self.manifest(version)
        for v in range(max(1, version - keep + 1), version):
            named = named.unionByName(self.manifest(v))
        live = {r[0].split("/data/", 1)[1] for r in named.select("path").distinct().toLocalIterator()}
        count = 0
        for at in files:
            place = at.toString().split("/data/", 1)[1]
            if at.getName().endswith(".parquet") and place not in live and place.split("/", 1)[0] not in busy:
                count += bool(fs.delete(at, False))
        return count

    # -- reading

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, with __shard_id."""
        rows = self.manifest(version)
        paths = [r[0] for r in rows.select("path").collect()]
        schema = self._schema()
        if not paths:
            return self.spark.createDataFrame([], schema or StructType()).withColumn("__shard_id", F.lit(None).cast("long"))
        data = self.spark.read.schema(schema).parquet(*paths).withColumn("__path", F.col("_metadata.file_path"))
        ids = small_side(rows.select(F.col("path").alias("__path"), F.col("shard_id").alias("__shard_id")))
        return data.join(ids, "__path").drop("__path")


def query(spark, sf_dir: str) -> DataFrame:
    """Documents arrive in ARRIVALS batches, are compacted, and are read back with their shards."""
    docs = table(spark, sf_dir, "documents")
    store = ShardStore(spark, scratch(spark, "shards"))
    store.append(docs.withColumn("__batch", F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))), "__batch")
    store.compact()
    store.vacuum()
    about = store.manifest().select(F.col("shard_id").alias("__shard_id"), "n_rows", "tier")
    rows = store.read().select("doc_id", "__shard_id").join(small_side(about), "__shard_id")
    return rows.select(
        "doc_id", F.col("__shard_id").alias("shard_id"), F.col("n_rows").alias("shard_rows"), F.col("tier").cast("long").alias("shard_tier"),
        F.lit(store.version()).cast("long").alias("version"),
    )
