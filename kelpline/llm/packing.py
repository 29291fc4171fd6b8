"""Packing by optimal length buckets.

Texts are cut into chunks of at most MAX_TOKENS words. Dynamic programming over
the histogram of all chunk lengths (at most MAX_TOKENS + 1 rows, the only thing
that reaches the driver besides the SHARDS counts of each bucket) chooses the
BUCKETS upper bounds with the least padding; among equal choices the one with
the smaller lower bounds. In a bucket, batches of floor(TOKEN_BUDGET / bound)
chunks form in the order of (doc_id mod SHARDS, doc_id, chunk, length): ranks are
taken in each shard and shifted by the counts of the shards before it, so no
bucket is sorted in one task.

Edges: a null or blank text is one chunk of length 0; a null id is in shard 0 and
sorts first. Repeated rows are chunks of their own. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .textstats import words

MAX_TOKENS = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384
SHARDS = 512


def bounds(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of the buckets that minimise the padding of a histogram of lengths."""
    lengths = sorted(histogram)
    if not lengths:
        return []
    length = np.array(lengths, dtype=np.int64)
    count = np.r_[0, np.cumsum([histogram[x] for x in lengths])]
    total = np.r_[0, np.cumsum([histogram[x] * x for x in lengths])]
    n, k = len(lengths), min(buckets, len(lengths))
    best = length * count[1:] - total[1:]  # padding of the first j + 1 lengths in one bucket
    came = []
    for step in range(1, k):
        new, source = np.full(n, np.iinfo(np.int64).max), np.zeros(n, dtype=np.int64)
        for j in range(step, n):
            i = np.arange(step - 1, j)
            cost = best[i] + length[j] * (count[j + 1] - count[i + 1]) - (total[j + 1] - total[i + 1])
            at = int(np.argmin(cost))
            new[j], source[j] = cost[at], i[at]
        best = new
        came.append(source)
    at, found = n - 1, [lengths[-1]]
    for source in reversed(came):
        at = int(source[at])
        found.append(lengths[at])
    return found[::-1]


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, chunk, n_tokens)."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.size(words(F.col(text_col))).alias("n"))
    last = F.greatest(F.ceil(F.col("n") / MAX_TOKENS).cast("int") - 1, F.lit(0))
    cut = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    return cut.select("doc_id", "chunk", F.least(F.lit(MAX_TOKENS), F.col("n") - F.col("chunk") * MAX_TOKENS).alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, chunk, n_tokens, bucket, bucket_len, batch, slot): one row per chunk."""
    spark = docs.sparkSession
    cut = written(chunks(docs, id_col, text_col), "chunks")
    ends = bounds({r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}) or [0]
    bucket = F.lit(1)
    for e in ends[:-1]:
        bucket = bucket + (F.col("n_tokens") > e).cast("int")
    shard = F.coalesce(F.pmod(F.col("doc_id"), F.lit(SHARDS)), F.lit(0)).cast("int")
    placed = cut.withColumns({"bucket": bucket, "shard": shard})
    ranks, offsets = {}, []
    for r in sorted(placed.groupBy("bucket", "shard").count().collect()):
        offsets.append((r[0], r[1], ranks.get(r[0], 0)))
        ranks[r[0]] = ranks.get(r[0], 0) + r[2]
    before = spark.createDataFrame(offsets, "bucket int, shard int, before bigint")
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "chunk", "n_tokens")
    ranked = placed.withColumn("rank", F.row_number().over(order)).join(F.broadcast(before), ["bucket", "shard"])
    end = F.element_at(F.array(*[F.lit(e) for e in ends]), F.col("bucket"))
    each = F.greatest(F.lit(1), F.floor(TOKEN_BUDGET / F.greatest(end, F.lit(1))))
    at = F.col("before") + F.col("rank") - 1
    return ranked.select(
        "doc_id", F.col("chunk").cast("long").alias("chunk"), F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("bucket").cast("long").alias("bucket"), end.cast("long").alias("bucket_len"),
        F.floor(at / each).cast("long").alias("batch"), (at % each).cast("long").alias("slot"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def _steps() -> str:
    steps = ["s1 AS (SELECT i, l * c - t AS cost, CAST(0 AS BIGINT) AS prev FROM p WHERE i > 0)"]
    for k in range(2, BUCKETS + 1):
        steps.append(
            f"""s{k} AS (SELECT i, min(cost) AS cost, min(prev) FILTER (WHERE cost = least) AS prev FROM (
                SELECT b.i, s.i AS prev, s.cost + b.l * (b.c - a.c) - (b.t - a.t) AS cost,
                       min(s.cost + b.l * (b.c - a.c) - (b.t - a.t)) OVER (PARTITION BY b.i) AS least
                FROM s{k - 1} s JOIN p a ON a.i = s.i JOIN p b ON b.i > s.i) GROUP BY i)"""
        )
    return ",\n".join(steps)


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n FROM documents),
e AS (SELECT doc_id, n, unnest(range(CAST(greatest(1, (n + {MAX_TOKENS - 1}) // {MAX_TOKENS}) AS BIGINT))) AS chunk FROM d),
c AS (SELECT doc_id, chunk, least({MAX_TOKENS}, n - chunk * {MAX_TOKENS}) AS n_tokens FROM e),
h AS (SELECT CAST(n_tokens AS BIGINT) AS l, count(*) AS c, row_number() OVER (ORDER BY n_tokens) AS i FROM c GROUP BY n_tokens),
p AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS l, CAST(0 AS BIGINT) AS c, CAST(0 AS BIGINT) AS t
      UNION ALL SELECT i, l, CAST(sum(c) OVER (ORDER BY i) AS BIGINT), CAST(sum(c * l) OVER (ORDER BY i) AS BIGINT) FROM h),
{_steps()},
s AS ({" UNION ALL ".join(f"SELECT {k} AS k, i, prev FROM s{k}" for k in range(1, BUCKETS + 1))}),
back AS (SELECT least({BUCKETS}, max(i)) AS k, max(i) AS i FROM h
         UNION ALL SELECT back.k - 1, s.prev FROM back JOIN s ON s.k = back.k AND s.i = back.i WHERE back.k > 1),
ends AS (SELECT back.k AS bucket, h.l AS bucket_len, lag(h.l, 1, -1) OVER (ORDER BY back.k) AS above FROM back JOIN h ON h.i = back.i),
ranked AS (
  SELECT doc_id, chunk, n_tokens, bucket, bucket_len, greatest(1, {TOKEN_BUDGET} // greatest(bucket_len, 1)) AS per,
         row_number() OVER (PARTITION BY bucket ORDER BY coalesce(doc_id % {SHARDS}, 0), doc_id NULLS FIRST, chunk, n_tokens) - 1 AS pos
  FROM c JOIN ends ON n_tokens > above AND n_tokens <= bucket_len)
SELECT doc_id, CAST(chunk AS BIGINT) AS chunk, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(bucket AS BIGINT) AS bucket,
       CAST(bucket_len AS BIGINT) AS bucket_len, CAST(pos // per AS BIGINT) AS batch, CAST(pos % per AS BIGINT) AS slot
FROM ranked
"""
