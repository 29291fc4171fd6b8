"""Near-duplicate components: SimHash with a pigeonring index, exact Jaccard similarity.

Two texts are linked if their sets of SHINGLE-word shingles have a Jaccard
similarity of at least NUMERATOR / DENOMINATOR; components are those of all links.

SimHash: each set has a 64-bit fingerprint, each of its shingles counted once. Pairs
that the pigeonring index of ``simhash`` brings together are checked on their sets;
those that reach the similarity make the first components. Sets at the similarity
differ in about 10 bits, over the index's budget, so the rest is found exactly:
all pairs of different first components that a prefix filter leaves are checked too.

Prefix filter: put all shingles in one global order. Texts that reach the
similarity share a shingle among the first n - ceil(t n) + 1 of the n of each, so
an equi-join on those prefixes loses no pair, whatever the order. Shingles that
come often in a sample go last, the others by hash, which keeps groups small.
At the first shingle that two texts share, both must have enough left behind it for the
similarity (positional filter): so the smaller one has it among its first ninth, and a
passage that many texts share brings few of them together.
Candidates of similar size meet first with BINS counts of their shingles by hash: the
sum of the smaller counts is at least what the sets share, so a pair that it leaves
below the similarity goes without its sets. The others are checked on their whole sets.

Work per group: equal sets are one row before the index is built. Groups up to
SHORT rows give all their pairs. Of a longer one each row first meets PIVOTS of
its rows. The pairs that these links leave in different components follow in turns:
in each turn a row looks at some of the rows left to it, is checked with the most
similar ones by their counts, and the components are found anew. A group that
left any possible pair out has a further turn, with more pairs a row; the last
turn leaves out none. So near copies cost rows in proportion to their number, and
pairs are checked one and all only where texts meet that are not similar.

Words are lower-case (ASCII) runs of non-space. A text of at most SHINGLE words is
one shingle, a null or blank text the empty set, linked to its equals. Shingles
and sets are known by XXH64. A row without doc_id takes part and keeps its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, small_side, written
from .components import components
from .simhash import majority
from .simhash import links as near_fingerprints

SEED, SHINGLE = 42, 5
NUMERATOR, DENOMINATOR = 4, 5
SHORT, PIVOTS = 32, 4
#: Rows that a row of a long group looks at for each pair it is checked in, and by how much the pairs grow each turn.
LOOK, MORE = 64, 8
#: Counts by hash that a pair is weighed with before its sets are.
BINS = 256
#: Texts that the order is taken from, and the shingles it may put last.
SAMPLE, COMMON = 20_000, 500_000
#: Pairs in one batch.
BATCH = 1 << 16
#: Pairs whose sets are in memory at once, in Spark and in Python.
CHECKED = 1000


def shingles(raw: bytes | None) -> np.ndarray:
    """Hashes of the different shingles of a UTF-8 text, sorted."""
    words = (raw or b"").lower().split()
    if not words:
        return np.array([], dtype=np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-SHINGLE] + 1).tolist()]
    return np.unique(np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)], dtype=np.uint64))


def _key(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def _bins(found: np.ndarray) -> bytes:
    """How many hashes fall in each of BINS, in the smallest integers that hold them."""
    counts = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=BINS)
    return counts.astype(np.min_scalar_type(counts.max())).tobytes()


def _counts(raw: pa.Scalar) -> np.ndarray:
    data = raw.as_buffer()
    return np.frombuffer(data, dtype=f"u{len(data) // BINS}")


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            found = np.concatenate([shingles(x.as_buffer().to_pybytes()) for x in batch.column(0).slice(k, 64)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["token"])


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that come three times or more in a sample of the texts, sorted, and how often."""
    share = int(min(1.0, SAMPLE / max(1, texts.count())) * (1 << 20)) + 1
    some = texts.where(F.pmod("text_hash", F.lit(1 << 20)) < share).select("text").mapInArrow(_sample, "token long")
    often = some.groupBy("token").count().where("count >= 3").orderBy(F.desc("count"), "token").limit(COMMON).toArrow()
    token = often.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], often.column("count").to_numpy()[order]


def _marks(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, size, fp, bins, prefix) per row; key names the text's set of shingles, fp is the set's fingerprint."""
    shared = texts.sparkSession.sparkContext.broadcast(_common(texts))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, times = shared.value
        for batch in batches:
            keys, sizes, fps, bins, prefixes = [], [], [], [], []
            for x in batch.column(2):
                found = shingles(x.as_buffer().to_pybytes())
                n = len(found)
                keys.append(_key(found))
                sizes.append(n)
                fps.append(majority(found) if n else 0)
                bins.append(_bins(found))
                if n and len(common):
                    place = np.minimum(np.searchsorted(common, found), len(common) - 1)
                    rank = np.where(common[place] == found, times[place], 0)
                    found = found[np.argsort(rank, kind="stable")]
                first = n - (-(-n * NUMERATOR // DENOMINATOR)) + 1 if n else 0
                prefixes.append(found[:first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(bins, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "key", "size", "fp", "bins", "prefix"],
            )

    return texts.select("doc_id", "text_hash", "text").mapInArrow(mark, "doc_id long, text_hash long, key long, size int, fp long, bins binary, prefix array<long>")


def _near(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets of sizes x and y can reach the similarity if the shingles at i and j are the first that they share."""
    return np.minimum(x - i, y - j) * (NUMERATOR + DENOMINATOR) >= (x + y) * NUMERATOR


def _leads(size: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether a row can be the smaller one of a pair."""
    return (size - pos) * (NUMERATOR + DENOMINATOR) >= 2 * size * NUMERATOR


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups: rows sorted by their first column, cut where it changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1], side="left"))
        if last or (held and held[-1][0][-1] != cols[0][0]):
            held.append([c[:last] for c in cols])
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        held.append([c[last:] for c in cols])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _groups(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.array([], dtype=int)
    return first, np.diff(np.r_[first, len(token)])


_PAIRS = "token long, key long, size long, pos long, a long, b long"


def _emit(a: np.ndarray | None, b: np.ndarray | None, *rows: np.ndarray) -> pa.RecordBatch:
    n = len(rows[0] if rows else a)
    col = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([col(x) for x in (*(rows or [None] * 4), a, b)], names=["token", "key", "size", "pos", "a", "b"])


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of short groups; of longer ones the pairs with the pivots, and their rows for the second turn."""
    for token, key, size, pos, root in _runs(batches):
        first, length = _groups(token)
        each = np.repeat(length, length)
        use = (each > 1) & (each <= SHORT)
        t, k, s, p, r = token[use], key[use], size[use], pos[use], root[use]
        for gap in range(1, SHORT):
            at = np.flatnonzero(t[gap:] == t[:-gap]) if len(t) > gap else np.array([], dtype=int)
            if not len(at):
                break
            at = at[(r[at] != r[at + gap]) & _near(s[at], p[at], s[at + gap], p[at + gap])]
            if len(at):
                yield _emit(k[at], k[at + gap])
        for i in np.flatnonzero(length > SHORT):
            rows = slice(first[i], first[i] + length[i])
            order = np.lexsort((key[rows], size[rows]))
            k, s, p, r = key[rows][order], size[rows][order], pos[rows][order], root[rows][order]
            leads = np.flatnonzero(_leads(s, p))
            if not len(leads) or (r == r[0]).all():
                continue
            for v in np.unique(leads[np.linspace(0, len(leads) - 1, PIVOTS).astype(int)]):
                other = _near(s, p, s[v], p[v]) & (r != r[v])
                if other.any():
                    yield _emit(k[other], np.full(other.sum(), k[v]))
            yield _emit(None, None, token[rows], k, s, p)


def _second_pairs(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Up to ``most`` pairs a row between the components of a group; if any possible pair is left out, the group's rows again."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, key, size, pos, root, bins in _runs(batches):
            for lo, n in zip(*_groups(token), strict=True):
                rows = slice(lo, lo + n)
                order = np.lexsort((key[rows], size[rows]))
                k, s, p, r = key[rows][order], size[rows][order], pos[rows][order], root[rows][order]
                if (r == r[0]).all():
                    continue
                counts = [np.frombuffer(x, dtype=f"u{len(x) // BINS}") for x in bins[rows][order]]
                counts = np.stack(counts).astype(max(c.dtype for c in counts))
                starts = np.searchsorted(s, s, side="left")
                ends = np.searchsorted(s, s * DENOMINATOR // NUMERATOR, side="right")
                names, often = np.unique(r, return_counts=True)
                main = names[often.argmax()]
                aside = np.flatnonzero(r != main)
                a, b, held, whole = [], [], 0, True
                for i in np.flatnonzero(_leads(s, p)):
                    if r[i] == main:
                        at = aside[np.searchsorted(aside, starts[i]) : np.searchsorted(aside, ends[i])]
                    else:
                        at = np.arange(starts[i], ends[i])
                    at = at[(r[at] != r[i]) & _near(s[at], p[at], s[i], p[i])]
                    if len(at) > most * LOOK:
                        whole = False
                        at = at[np.linspace(0, len(at) - 1, most * LOOK).astype(int)]
                    both = np.minimum(counts[at], counts[i]).sum(1, dtype=np.int64)
                    at, both = (x[both * DENOMINATOR >= (s[at] + s[i] - both) * NUMERATOR] for x in (at, both))
                    if len(at) > most:
                        whole = False
                        at = at[np.argsort(-both / (s[at] + s[i] - both), kind="stable")[:most]]
                    a.append(np.full(len(at), k[i]))
                    b.append(k[at])
                    held += len(at)
                    if held >= BATCH:
                        yield _emit(np.concatenate(a), np.concatenate(b))
                        a, b, held = [], [], 0
                if held:
                    yield _emit(np.concatenate(a), np.concatenate(b))
                if not whole:
                    yield _emit(None, None, token[rows], k, s, p)

    return turn


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(x.as_buffer().to_pybytes()) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([_key(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], names=["key", "tokens"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose counts leave room for the similarity."""
    for batch in batches:
        ok = np.zeros(batch.num_rows, dtype=bool)
        sizes = [batch.column(k).to_numpy() for k in (2, 3)]
        for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
            most = int(np.minimum(_counts(x), _counts(y)).sum())
            ok[i] = most * DENOMINATOR >= (int(sizes[0][i]) + int(sizes[1][i]) - most) * NUMERATOR
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(ok)) for k in (0, 1)], names=["a", "b"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        ok = np.zeros(len(a), dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok[i] = both * DENOMINATOR >= (len(x) + len(y) - both) * NUMERATOR
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame, unique: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the similarity."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    weighed = [unique.select(F.col("key").alias(k), F.col("size").alias(f"size_{k}"), F.col("bins").alias(f"bins_{k}")) for k in ("a", "b")]
    met = pairs.join(weighed[0], "a").join(weighed[1], "b").select("a", "b", "size_a", "size_b", "bins_a", "bins_b")
    pairs = written(met.mapInArrow(_possible, "a long, b long"), "candidates")
    needed = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()
    hashes = written(unique.join(needed, "key", "left_semi").select("text_hash").distinct(), "needed")
    rows = texts.join(small_side(hashes), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    sets = written(rows.select("text").mapInArrow(_sets, "key long, tokens binary").dropDuplicates(["key"]), "sets")
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    with batch_rows(texts.sparkSession, CHECKED):
        return written(joined.mapInArrow(_check, "a long, b long"), "similar")


def _fingerprint_pairs(unique: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets near each other by fingerprint: a tree over each fingerprint's sets and over each component of fingerprints."""
    fps = written(unique.groupBy("fp").agg(F.min("key").alias("one")), "fingerprints")
    same = unique.join(fps, "fp").where("key <> one").select(F.col("one").alias("a"), F.col("key").alias("b"))
    near = written(near_fingerprints(fps.select("fp")), "near")
    named = [fps.select(F.col("fp").alias(f"fp_{k}"), F.col("one").alias(k)) for k in ("a", "b")]
    near = near.select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b")).join(named[0], "fp_a").join(named[1], "fp_b")
    return same.unionAll(near.select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, component_id): one row per input row; key names its set of shingles."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    marks = written(_marks(texts), "marks")
    least = [F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash")]
    unique = written(marks.groupBy("key").agg(*least, *(F.first(c).alias(c) for c in ("size", "fp", "bins", "prefix"))), "unique")
    links = _links(_fingerprint_pairs(unique), texts, unique)
    roots = components(links)
    rooted = unique.join(roots, unique.key == roots.node, "left").select("key", F.col("size").cast("long").alias("size"), "prefix", F.coalesce("root", "key").alias("root"))
    index = rooted.select(F.posexplode("prefix").alias("pos", "token"), "key", "size", "root").select("token", "key", "size", F.col("pos").cast("long").alias("pos"), "root")
    found = written(index.repartition("token").sortWithinPartitions("token").mapInArrow(_first_pairs, _PAIRS), "pairs")
    most = PIVOTS
    while not found.isEmpty():
        more = _links(found.where("a is not null").select("a", "b"), texts, unique)
        if not more.isEmpty():
            links = links.unionAll(more)
            roots = components(links)
        long = found.where("a is null").select("token", "key", "size", "pos")
        long = long.join(roots, long.key == roots.node, "left").select("token", "key", "size", "pos", F.coalesce("root", "key").alias("root")).join(unique.select("key", "bins"), "key")
        long = long.select("token", "key", "size", "pos", "root", "bins").repartition("token").sortWithinPartitions("token")
        found = written(long.mapInArrow(_second_pairs(most), _PAIRS), "pairs")
        most *= MORE
    members = unique.join(roots, unique.key == roots.node, "left").select("key", "first_id", F.coalesce("root", "key").alias("root"))
    members = written(members, "members")
    named = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = members.join(named, "root").select("key", "component_id")
    return marks.select("doc_id", "key").join(by_key, "key").select("doc_id", "key", "component_id")
