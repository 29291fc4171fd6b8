"""SimHash near-duplicates with a pigeonring index.

A 64-bit fingerprint is cut into RING segments laid out as a ring. If two
fingerprints differ in at most BUDGET bits, then by the pigeonring principle
(Qin and Xiao, VLDB 2018) some start exists from which every chain of l
consecutive segments has at most floor(l * BUDGET / RING) differing bits. Over
the first CHAIN segments of such a chain those proportional budgets leave at
least four segments untouched, in one of PATTERNS; the untouched bits (28 of
64) are the join key. Candidates that share a key must pass every prefix
budget of their chain before the full Hamming check.

Work per key: equal fingerprints are one row before the index is built, groups
are compared inside a task with array arithmetic, and only the edges of a
spanning forest leave it. A group above BLOCK rows is dealt anew as pairs of
blocks, so no task holds an unbounded group and no group emits all its pairs.

Nulls: a null text is an empty one (fingerprint zero, linked like any other).
A row without doc_id takes part and keeps its row; it can never be the smallest
id, and a component of such rows only has a null component_id. Repeated rows
and ids are kept, one output row each. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

SEED, SHINGLE = 42, 4
BUDGET, RING, CHAIN = 4, 9, 6
BLOCK = 4096
#: Runs up to this length are compared pair by pair; longer ones by breadth-first search.
SHORT = 32

_WIDTHS = [64 // RING + (k < 64 % RING) for k in range(RING)]
_SEGMENTS = [((1 << w) - 1) << sum(_WIDTHS[:k]) for k, w in enumerate(_WIDTHS)]
_ALLOWED = [(length * BUDGET) // RING for length in range(1, RING + 1)]


def _patterns() -> list[tuple[int, ...]]:
    """Offsets that must be untouched: all choices that the budgets of a chain of CHAIN allow."""
    from itertools import combinations

    free = _ALLOWED[CHAIN - 1]
    found = []
    for touched in combinations(range(CHAIN), free):
        if all(sum(t < length for t in touched) <= _ALLOWED[length - 1] for length in range(1, CHAIN + 1)):
            found.append(tuple(k for k in range(CHAIN) if k not in touched))
    return found


PATTERNS = _patterns()
#: (start, mask of the key's bits) for each kind of key.
KEYS = [(start, sum(_SEGMENTS[(start + k) % RING] for k in p)) for start in range(RING) for p in PATTERNS]


def fingerprint(raw: bytes | None) -> int:
    """SimHash of a UTF-8 text over its 4-word shingles, repeats included."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return majority([xxhash.xxh64_intdigest(line, SEED)])
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return majority([digest(line[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)])


def majority(hashes: list[int]) -> int:
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(values), 1 << 16):
        part = values[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint as a signed long."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).mapInArrow(_fingerprints, "doc_id long, fp long")


def _viable(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which differences pass every prefix budget of the chain from ``start``, and then the full check."""
    touched = np.stack([np.bitwise_count(x & np.uint64(s)) for s in _SEGMENTS], axis=1).astype(np.int64)
    ok = np.ones(len(x), dtype=bool)
    total = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    for length in range(1, RING + 1):
        total += touched[rows, (start + length - 1) % RING]
        ok &= total <= _ALLOWED[length - 1]
    return ok


def _forest(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the viable pairs of one group."""
    edges, left = [], fps.copy()
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _viable(left ^ at, np.full(len(left), start))
            edges += [(int(at), int(v)) for v in left[near]]
            queue += list(left[near])
            left = left[~near]
    return edges


_LINKS = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("block", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _emit(a, b, key=None, kind=None, block=None) -> pa.RecordBatch:
    n = len(a)
    col = lambda x, t: pa.array(x, t) if x is not None else pa.nulls(n, t)
    signed = lambda x: None if x is None else np.asarray(x, dtype=np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [col(key, pa.int64()), col(kind, pa.int32()), col(block, pa.int32()), col(signed(a), pa.int64()), col(signed(b), pa.int64())],
        schema=_LINKS,
    )


def _compare_runs(key: np.ndarray, kind: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of whole groups; rows of a group are adjacent and each group has at most BLOCK rows."""
    starts = np.array([s for s, _ in KEYS])
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    length = np.repeat(size, size)
    use = (length > 1) & (length <= SHORT)
    k, g, f = key[use], kind[use], fp[use]
    for gap in range(1, SHORT):
        at = np.flatnonzero(k[gap:] == k[:-gap]) if len(k) > gap else np.array([], dtype=int)
        if not len(at):
            break
        x, y = f[at], f[at + gap]
        ok = _viable(x ^ y, starts[g[at]])
        if ok.any():
            yield _emit(x[ok], y[ok])
    for i in np.flatnonzero(size > SHORT):
        rows = slice(first[i], first[i] + size[i])
        if edges := _forest(fp[rows], starts[kind[first[i]]]):
            yield _emit(*(np.array(c, dtype=np.uint64) for c in zip(*edges, strict=True)))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> links (a, b), and the rows of groups above BLOCK with their block."""
    held: list[np.ndarray] = [np.array([], dtype=t) for t in (np.int64, np.int32, np.uint64)]
    big, seen = None, 0  # the key whose rows are passed on, and how many were
    for batch in batches:
        cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
        key, kind, fp = (np.concatenate([h, c]) for h, c in zip(held, cols, strict=True))
        if not len(key):
            continue
        if big is not None and key[0] == big:
            n = int(np.searchsorted(key, big, side="right"))
            yield _emit(fp[:n], None, key[:n], kind[:n], ((seen + np.arange(n)) // BLOCK).astype(np.int32))
            seen += n
            key, kind, fp = key[n:], kind[n:], fp[n:]
            if len(key):
                big = None
        if not len(key):
            held = [key, kind, fp]
            continue
        last = int(np.searchsorted(key, key[-1], side="left"))
        yield from _whole(key[:last], kind[:last], fp[:last])
        key, kind, fp = key[last:], kind[last:], fp[last:]
        if len(key) > BLOCK:
            big, seen = key[0], len(key)
            yield _emit(fp, None, key, kind, (np.arange(seen) // BLOCK).astype(np.int32))
            key, kind, fp = key[:0], kind[:0], fp[:0]
        held = [key, kind, fp]
    yield from _whole(*held)


def _whole(key: np.ndarray, kind: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Groups that ended: compared here, or passed on in blocks where they are large."""
    if not len(key):
        return
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    small = np.repeat(size <= BLOCK, size)
    if not small.all():
        order = np.arange(len(key)) - np.repeat(first, size)
        yield _emit(fp[~small], None, key[~small], kind[~small], (order[~small] // BLOCK).astype(np.int32))
        key, kind, fp = key[small], kind[small], fp[small]
    if len(key):
        yield from _compare_runs(key, kind, fp)


def _block_links(rows: pa.Table) -> pa.Table:
    fp = np.unique(rows.column("a").to_numpy().view(np.uint64))
    edges = _forest(fp, KEYS[rows.column("kind")[0].as_py()][0])
    a, b = (np.array([e[k] for e in edges], dtype=np.uint64).view(np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(distinct_fps: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints whose components are those of all links."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed(m)))) for k, (_, m) in enumerate(KEYS)])
    rows = distinct_fps.select("fp", F.posexplode(keys).alias("kind", "key")).select("key", "kind", "fp")
    found = written(
        rows.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "key long, kind int, block int, a long, b long"),
        "links",
    )
    large = found.where("key is not null")
    spans = large.groupBy("key").agg(F.max("block").alias("blocks"))
    pairs = (
        large.join(spans, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks"))))
        .select("key", "kind", "a", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )
    dealt = pairs.groupBy("key", "lo", "hi").applyInArrow(_block_links, "a long, b long")
    return found.where("key is null").select("a", "b").unionAll(dealt)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per input row."""
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(least.select("fp")))
    members = least.join(roots, least.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    members = written(members, "members")
    named = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = members.join(named, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
