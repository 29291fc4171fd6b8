"""Stupid-backoff language-model scores from n-gram count tables partitioned by hash.

Words are lower-case runs of non-space. With c the counts over all texts, an n-gram
g of k words ending in w, its context g' (without w) and its tail g" (without its
first word),

    S(g) = c(g) / c(g')       if c(g) >= MIN_COUNT
         = ALPHA * S(g")       otherwise
    S(w) = c(w) / all words

for k up to ORDER; the first words of a text have shorter contexts. Logarithms are
summed per text. MIN_COUNT 1 uses all counts; texts scored by counts of other texts,
or with a larger MIN_COUNT, back off.

The n-grams of all texts are far more rows than anything else, so they travel in
packed rows. A task takes CHUNK words of whole texts and sums up each different n-gram
of the chunk (the exploded side, combined before it shuffles); the table (hash, count)
is cut by hash into buckets, of which there are as many as BUCKET words of the corpus
give. A bucket adds up its n-grams over all chunks (the count table) and answers each
chunk with its totals in the order that they came (the join), and the chunk sums the
logarithms of its texts, which come to it by a second read (a chunk is known by its
content; should the texts differ between the reads, the job fails). An n-gram that every text has is one entry of each chunk, so
no bucket is hotter than the rest; nothing is broadcast or sent to the driver but the
number of words.

Edges: a null or blank text has no words, score 0 and a null mean. Repeated rows
count in the tables as often as they come and each gets its score. N-grams are known
by a 64-bit mix of their words' XXH64, of which a bucket keeps KEPT bits besides its
number: of a million different ones about one meets another, whatever the size of
the corpus. Other columns are ignored. A text is held whole, at about 60 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .textstats import words

ALPHA = 0.4
ORDER, MIN_COUNT = 3, 1
CHUNK, BUCKET, BUCKETS = 1 << 19, 1 << 20, 64
#: Bits that a bucket keeps of a hash.
KEPT = 40
#: Texts of a chunk; words whose hashes a worker remembers.
TEXTS, REMEMBERED = 60_000, 500_000


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of a pair of hashes."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _grams(h: np.ndarray, sizes: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 1 .. order: the positions at which an n-gram of k words ends, and their hashes."""
    place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, found = np.arange(len(h)), h
    full = h.copy()
    for k in range(1, order + 1):
        yield at, found
        at = np.flatnonzero(place >= k)
        found = _mix(full[at - 1], h[at])
        full[at] = found


def _pressed(x: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as hold them, byte by byte, compressed."""
    if not len(x):
        return b""
    x = x.astype(np.min_scalar_type(int(x.max())))
    return bytes([x.itemsize]) + pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T), codec="zstd", asbytes=True)


def _unpressed(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.array([], dtype=np.int64)
    raw = pa.decompress(data[1:], decompressed_size=n * data[0], codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(data[0], n).T).view(f"u{data[0]}").ravel().astype(np.int64)


#: own rows have ids, nulls, sizes, words and seq; the others k, start, size, first and keys (steps between
#: the sorted hashes, on the way to a bucket) and n.
_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("seq", pa.binary())]
    + [("k", pa.int32()), ("start", pa.int64()), ("size", pa.int64()), ("first", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]
)
_DDL = "bucket int, chunk bigint, ids binary, nulls binary, sizes binary, words binary, seq binary, k int, start bigint, size bigint, first bigint, keys binary, n binary"


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in _SCHEMA], schema=_SCHEMA)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of one key at a time, from batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _packed(ids: list, lists: list[list[int]], buckets: int, order: int) -> pa.RecordBatch:
    """A chunk's own row (where ``buckets`` is 0), or its n-grams by bucket. The chunk is known by its content."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    h = np.array([v for x in lists for v in x], dtype=np.uint64)
    numbers, nulls = np.array([x or 0 for x in ids], dtype=np.int64).tobytes(), np.array([x is None for x in ids]).tobytes()
    chunk = xxhash.xxh3_64_intdigest(numbers + nulls + sizes.tobytes() + h.tobytes()) >> 1
    different, place, times = np.unique(h, return_inverse=True, return_counts=True)
    if not buckets:
        often = np.argsort(-times, kind="stable")  # frequent words get small numbers
        number = np.empty(len(often), dtype=np.uint32)
        number[often] = np.arange(len(often), dtype=np.uint32)
        return _rows([{"chunk": chunk, "ids": numbers, "nulls": nulls, "sizes": sizes.tobytes(), "words": different[often].tobytes(), "seq": _pressed(number[place])}])
    rows = []
    shift = np.uint64(64 - KEPT - (buckets - 1).bit_length())
    for k, (_, found) in enumerate(_grams(h, sizes, order), 1):
        keys, times = (different, times) if k == 1 else np.unique(found, return_counts=True)
        if not len(keys):
            continue
        bucket = ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
        kept = keys >> shift
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            about = {"bucket": int(bucket[lo]), "chunk": chunk, "k": k, "start": int(lo), "size": int(hi - lo), "first": int(kept[lo : lo + 1].view(np.int64)[0])}
            rows.append(about | {"keys": _pressed(np.diff(kept[lo:hi], prepend=kept[lo])), "n": _pressed(times[lo:hi])})
    return _rows(rows)


def _totals(parts: list[dict]) -> Iterator[pa.RecordBatch]:
    """A bucket's n-grams of one length, added up over all chunks; an answer to each."""
    sizes = [r["size"] for r in parts]
    keys = np.concatenate([r["first"] + np.cumsum(_unpressed(r["keys"], r["size"])) for r in parts])
    different, place = np.unique(keys, return_inverse=True)
    n = np.concatenate([_unpressed(r["n"], r["size"]) for r in parts])
    total = np.zeros(len(different), dtype=np.int64)
    np.add.at(total, place, n)
    total, at, out = total[place], 0, []
    for r, size in zip(parts, sizes, strict=True):
        out.append({"chunk": r["chunk"], "k": r["k"], "start": r["start"], "size": size, "n": _pressed(total[at : at + size])})
        at += size
    yield _rows(out)


def _scored(run: list[dict], order: int, min_count: int, log_total: float) -> Iterator[pa.RecordBatch]:
    """The texts of a chunk with their scores, as often as the chunk comes."""
    owners = [r for r in run if r["ids"] is not None]
    if not owners:
        raise RuntimeError("the texts changed between two reads")
    own = owners[0]
    sizes = np.frombuffer(own["sizes"], dtype=np.int64)
    h = np.frombuffer(own["words"], dtype=np.uint64)[_unpressed(own["seq"], int(sizes.sum()))]
    value, before = np.zeros(len(h)), np.zeros(len(h))
    for k, (at, found) in enumerate(_grams(h, sizes, order), 1):
        different, place = np.unique(found, return_inverse=True)
        total = np.zeros(len(different), dtype=np.int64)  # a total is at least 1
        for r in run:
            if r["k"] == k:
                total[r["start"] : r["start"] + r["size"]] = _unpressed(r["n"], r["size"])
        if not total.all():
            raise RuntimeError("the texts changed between two reads")
        n = total[place]
        logs = np.log(np.maximum(n, 1))
        if k == 1:
            value = logs - log_total
        else:
            value[at] = np.where(n >= min_count, logs - before[at - 1], np.log(ALPHA) + value[at])
        before = np.zeros(len(h))
        before[at] = logs
    score = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=value, minlength=len(sizes)).astype(float)
    ids = pa.array(np.frombuffer(own["ids"], dtype=np.int64), mask=np.frombuffer(own["nulls"], dtype=bool))
    mean = pa.array(score / np.maximum(sizes, 1), mask=sizes == 0)
    for _ in owners:
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(score), mean], names=["doc_id", "n_words", "score", "mean"])


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """(doc_id, n_words, score, mean): one row per input row."""
    total = docs.agg(F.coalesce(F.sum(F.size(words(F.col(text_col)))), F.lit(0))).first()[0]
    buckets = min(max(BUCKETS, -(-total // BUCKET)), 1 << 24)
    log_total = float(np.log(max(total, 1)))

    def chunks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        digest = xxhash.xxh64_intdigest
        ids: list = []
        lists: list[list[int]] = []
        size = 0
        for batch in batches:
            for doc, raw in zip(batch.column(0), batch.column(1), strict=True):
                hashes = []
                for w in raw.as_buffer().to_pybytes().split():
                    v = known.get(w)
                    if v is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        v = known[w] = digest(w, 42)
                    hashes.append(v)
                ids.append(doc.as_py())
                lists.append(hashes)
                size += len(hashes)
                if size >= CHUNK or len(lists) >= TEXTS:
                    yield _packed(ids, lists, buckets, order)
                    ids, lists, size = [], [], 0
        if lists:
            yield _packed(ids, lists, buckets, order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunks(batches, buckets)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunks(batches, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "bucket"):
            for k in range(1, order + 1):
                if parts := [r for r in run if r["k"] == k]:
                    yield from _totals(parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "chunk"):
            yield from _scored(run, order, min_count, log_total)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("text"))
    packed = texts.mapInArrow(pack, _DDL).repartition("bucket").sortWithinPartitions("bucket")
    both = packed.mapInArrow(count, _DDL).unionAll(texts.mapInArrow(keep, _DDL))
    return both.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "doc_id bigint, n_words bigint, score double, mean double")


def query(spark, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents")).select("doc_id", "n_words", F.round("score", 4).alias("score"), F.round("mean", 6).alias("mean"))


ORACLE = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
t AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i, unnest(list_prepend(NULL, words[:-2])) AS v, unnest(list_concat([NULL, NULL], words[:-3])[:len(words)]) AS u FROM d WHERE len(words) > 0),
c1 AS (SELECT w, count(*) AS n FROM t GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM t WHERE i > 0 GROUP BY v, w),
c3 AS (SELECT u, v, w, count(*) AS n FROM t WHERE i > 1 GROUP BY u, v, w),
z AS (SELECT sum(n) AS total FROM c1),
s AS (SELECT t.doc_id, sum(CASE
        WHEN i > 1 AND c3.n >= {MIN_COUNT} THEN ln(c3.n) - ln(b2.n)
        WHEN i > 0 AND c2.n >= {MIN_COUNT} THEN (i > 1)::INT * ln({ALPHA}) + ln(c2.n) - ln(b1.n)
        ELSE least(i, 2) * ln({ALPHA}) + ln(c1.n) - ln(total) END) AS score
      FROM t CROSS JOIN z JOIN c1 USING (w) LEFT JOIN c1 b1 ON b1.w = t.v LEFT JOIN c2 ON c2.v = t.v AND c2.w = t.w
      LEFT JOIN c2 b2 ON b2.v = t.u AND b2.w = t.v LEFT JOIN c3 ON c3.u = t.u AND c3.v = t.v AND c3.w = t.w GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, round(coalesce(score, 0), 4) AS score, round(score / len(words), 6) AS mean
FROM d LEFT JOIN s USING (doc_id)
"""
