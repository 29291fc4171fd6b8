"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - score), with one weight vector over hashed
text features for all grades and ordered thresholds. A text's features are, per
distinct word, the word, its first 4, 5 and 6 characters and the marks it ends
in, weighted by log(1 + count) and divided by the norm of the word weights, and
three shares of form: words in capitals, immediate repeats, and words that are
or end in marks. Features count only where they lower the grade: what marks good
texts is mostly common words, and without them a short good text would be
rejected for lack of evidence.

Fitting takes at most SAMPLE labelled rows for each grade, those with the
smallest hash of their id. That bound is a parameter. Their features are made on
the executors from whole texts and counted there; the driver gets the counts of at
most 2^BITS features, then the rows with only the features that tell grades apart,
and minimises the penalised likelihood with L-BFGS. Scoring maps over all rows; the model is a fixed-size array.

Nulls and edges: a null or blank text has score 0 before thresholds. Labels
without an id, without a document or with both ratings null are left out; of
several ratings of one id the worst counts. A grade without rows leaves its
threshold at the prior. Without any labels all rows get the prior's
probabilities and are kept. Repeated rows are scored each; other columns and
clashing names pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

BITS = 18
GRADES = 3
SAMPLE = 1500
#: Of the thresholds and of the weights.
PENALTY, SHRINK = 1e-3, 3e-4
#: A feature needs this many sampled texts, and this likelihood ratio against even spread, to get a weight.
MIN_TEXTS, TELLING = 4, 15.0
#: Scale of the values while fitting, so that weights stay near one.
STRETCH = 10.0
#: Fits, each without the features to which the one before gave a positive weight.
PRUNING = 4
ROUNDS = 60
#: A row is kept if P(grade = best) is at least this.
KEEP = 0.5
#: Words whose weights a scoring worker remembers.
REMEMBERED = 200_000


def grade(quality, toxic):
    """Toxic texts are the worst grade, then poor ones, then good ones."""
    return F.when(F.coalesce(toxic, F.lit(0)) == 1, 0).when(F.coalesce(quality, F.lit(1)) == 0, 1).otherwise(2)


def _index(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def word_features(word: str) -> list[int]:
    core = word.strip(".,;:!?\"'()[]{}*#$%&|<>+-=/\\_~^`@")
    tail = word[len(word.rstrip(".,;:!?\"'()[]{}*#$%&|<>+-=/\\_~^`@")) :]
    found = [_index("w" + core)] if core else [_index("mark")]
    found += [_index(f"p{n}{core[:n]}") for n in (4, 5, 6) if len(core) >= n]
    if len(tail) > 1:
        found.append(_index("t" + tail[:4]))
    return found


FORMS = ("\tcapitals", "\trepeats", "\tmarks")


def counted(text: str | None) -> tuple[Counter, tuple[float, float, float]]:
    """Lower-case words with counts, and the square roots of the shares of FORMS."""
    words = (text or "").split()
    lower = [w.lower() for w in words]
    n = max(len(words), 1)
    capitals = sum(len(w) > 2 and w.isupper() for w in words)
    repeats = sum(a == b for a, b in zip(lower, lower[1:], strict=False))
    marks = sum(not (w[-1].isalnum() or w[-2:-1].isalnum()) for w in words)
    return Counter(lower), ((capitals / n) ** 0.5, (repeats / n) ** 0.5, (marks / n) ** 0.5)


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a text."""
    words, forms = counted(text)
    idx, val, norm = [], [], 0.0
    for word, n in words.items():
        v = float(np.log1p(n))
        norm += v * v
        for i in word_features(word):
            idx.append(i)
            val.append(v)
    values = np.array(val, dtype=np.float32) / np.float32(max(norm, 1.0) ** 0.5)
    shares = [(_index(name), share) for name, share in zip(FORMS, forms, strict=True) if share]
    return (
        np.array(idx + [i for i, _ in shares], dtype=np.int32),
        np.concatenate([values, np.array([v for _, v in shares], dtype=np.float32)]),
    )


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES - 1, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _seen(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray) -> np.ndarray:
    """Texts with each feature, by grade."""
    each = [[np.unique(i) for (i, _), y in zip(rows, grades, strict=True) if y == k] for k in range(GRADES)]
    return np.stack([np.bincount(np.concatenate(e or [np.array([], dtype=int)]), minlength=1 << BITS) for e in each])


def _telling(seen: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Features that come unevenly over the grades, and more with low ones.

    ``seen`` counts the texts with each feature by grade (one row each), ``texts`` all texts by grade.
    The likelihood ratio of texts with the feature tells the first. Features of good texts are mostly
    common words; with them a short good text would lack evidence.
    """
    seen, n = seen.astype(float), max(texts.sum(), 1)
    expected = texts[:, None] / n * seen.sum(0)
    ratio = 2 * np.where(seen > 0, seen * np.log(np.where(seen > 0, seen, 1) / np.maximum(expected, 1e-12)), 0).sum(0)
    mean = (np.arange(GRADES) @ seen) / np.maximum(seen.sum(0), 1)
    return (ratio >= TELLING) & (seen.sum(0) >= MIN_TEXTS) & (mean < np.arange(GRADES) @ texts / n)


def fit_arrays(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, shares: np.ndarray | None = None, wanted: np.ndarray | None = None) -> Model:
    """Penalised maximum likelihood by L-BFGS; ``shares`` are the grades' shares of all ratings, ``wanted`` marks the features."""
    prior = np.arange(1, GRADES) - GRADES / 2.0
    if not len(rows):
        return Model(np.zeros(1 << BITS, dtype=np.float32), prior - 10.0)
    size = np.array([len(i) for i, _ in rows])
    row = np.repeat(np.arange(len(rows)), size)
    flat, val = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(float)
    if wanted is None:
        wanted = _telling(_seen(rows, grades), np.bincount(grades, minlength=GRADES))
    wanted[[_index(name) for name in FORMS]] = True
    for _ in range(PRUNING):
        model = _fit(row, flat, val, grades, shares, wanted, prior)
        wanted &= model.weights < 0
    return model


def _fit(row, flat, val, grades, shares, wanted, prior) -> Model:
    common = wanted[flat]
    row, flat, val = row[common], flat[common], val[common]
    idx, inverse = np.unique(flat, return_inverse=True)
    counts = np.bincount(grades, minlength=GRADES).astype(float)
    shares = counts / counts.sum() if shares is None else shares
    share = (shares / np.maximum(counts, 1))[grades]
    share /= share.sum()
    d, k = len(idx), GRADES - 1
    val = val * STRETCH

    def loss(x):
        w, cut = x[:d], np.cumsum(np.r_[x[d], np.exp(np.clip(x[d + 1 :], -20, 20))])
        s = np.bincount(row, weights=val * w[inverse], minlength=len(grades))
        upper, lower = np.r_[cut, np.inf][grades] - s, np.r_[-np.inf, cut][grades] - s
        pu = np.where(np.isinf(upper), 1.0, _sigmoid(np.where(np.isinf(upper), 0, upper)))
        pl = np.where(np.isinf(lower), 0.0, _sigmoid(np.where(np.isinf(lower), 0, lower)))
        p = np.maximum(pu - pl, 1e-12)
        du, dl = pu * (1 - pu) * ~np.isinf(upper), pl * (1 - pl) * ~np.isinf(lower)
        gs = share * (du - dl) / p  # d loss / d score
        g = np.empty_like(x)
        g[:d] = np.bincount(inverse, weights=val * gs[row], minlength=d) + SHRINK * w
        gcut = np.zeros(k)
        np.add.at(gcut, np.minimum(grades, k - 1), -share * du / p * (grades < k))
        np.add.at(gcut, np.maximum(grades - 1, 0), share * dl / p * (grades > 0))
        raw = cut - prior
        gcut += PENALTY * raw
        g[d] = gcut.sum()
        for j in range(1, k):
            g[d + j] = gcut[j:].sum() * np.exp(np.clip(x[d + j], -20, 20))
        return -(share * np.log(p)).sum() + SHRINK / 2 * (w @ w) + PENALTY / 2 * (raw @ raw), g

    x = np.r_[np.zeros(d), prior[0], np.zeros(k - 1)]
    x = _lbfgs(loss, x)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[idx] = x[:d]
    weights *= STRETCH
    return Model(weights, np.cumsum(np.r_[x[d], np.exp(np.clip(x[d + 1 :], -20, 20))]))


def _lbfgs(loss, x, memory: int = 8):
    f, g = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(ROUNDS):
        q, alphas = g.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ q)
            alphas.append(a)
            q -= a * y
        if steps:
            s, y, _r = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(np.linalg.norm(g), 1e-12)
        for (s, y, r), a in zip(steps, reversed(alphas), strict=True):
            q += s * (a - r * (y @ q))
        t, slope = 1.0, -(g @ q)
        for _try in range(30):
            fx, gx = loss(x - t * q)
            if fx <= f + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = -t * q, gx - g
        done = f - fx < 1e-9 * max(1.0, abs(f))
        x, f, g = x + s, fx, gx
        if s @ y > 1e-12:
            steps = [*steps[-memory + 1 :], (s, y, 1 / (s @ y))]
        if done:
            break
    return x


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            some = batch.slice(k, 64)
            pairs = [vector(t.as_py()) for t in some.column(1)]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([i for i, _ in pairs], pa.list_(pa.int32())), pa.array([v for _, v in pairs], pa.list_(pa.float32()))], names=["grade", "idx", "val"]
            )


def _wanted_only(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, val = [], []
            for i, v in zip(batch.column(1), batch.column(2), strict=True):
                i, v = i.values.to_numpy(), v.values.to_numpy()
                keep = wanted[i]
                idx.append(i[keep].tobytes())
                val.append(v[keep].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["grade", "idx", "val"])

    return run


def rated(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(id, grade): one row per rated id."""
    known = F.col(id_col).isNotNull() & (F.col(quality_col).isNotNull() | F.col(toxic_col).isNotNull())
    return labels.where(known).groupBy(F.col(id_col).alias("id")).agg(F.min(grade(F.col(quality_col), F.col(toxic_col))).alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """A model from ``grades`` (id, grade) and the texts of ``docs``."""
    per = [grades.where(F.col("grade") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in range(GRADES)]
    chosen = per[0]
    for p in per[1:]:
        chosen = chosen.unionAll(p)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most GRADES * sample rows of 12 bytes
    rows = texts.join(F.broadcast(chosen), "id").select("grade", "text").mapInArrow(_vectors, "grade int, idx array<int>, val array<float>")
    rows = written(rows, "vectors")
    n = np.zeros(GRADES, dtype=np.int64)
    for k, count in rows.groupBy("grade").count().collect():
        n[k] = count
    # at most 2^BITS rows, whatever the texts hold
    by_grade = [F.count_if(F.col("grade") == k).alias(f"n{k}") for k in range(GRADES)]
    often = rows.select("grade", F.explode(F.array_distinct("idx")).alias("idx")).groupBy("idx").agg(*by_grade, F.count("*").alias("n")).where(F.col("n") >= MIN_TEXTS).toArrow()
    seen = np.zeros((GRADES, 1 << BITS), dtype=np.int64)
    for k in range(GRADES):
        seen[k, often.column("idx").to_numpy()] = often.column(f"n{k}").to_numpy()
    wanted = _telling(seen, n)
    wanted[[_index(name) for name in FORMS]] = True
    got = rows.mapInArrow(_wanted_only(wanted), "grade int, idx binary, val binary").toArrow()
    vectors = [
        (np.frombuffer(i.as_py(), dtype=np.int32), np.frombuffer(v.as_py(), dtype=np.float32))
        for i, v in zip(got.column("idx"), got.column("val"), strict=True)
    ]
    order = sorted(range(len(vectors)), key=lambda k: (got.column("grade")[k].as_py(), vectors[k][0].tobytes(), vectors[k][1].tobytes()))
    rated_rows = dict(grades.groupBy("grade").count().collect())
    shares = np.array([rated_rows.get(k, 0) for k in range(GRADES)], dtype=float)
    y = np.array([got.column("grade")[k].as_py() for k in order], dtype=int)
    return fit_arrays([vectors[k] for k in order], y, shares / max(shares.sum(), 1.0), wanted)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with __expected (grade), __tails (P(grade >= k), k from 1) and __kept."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = shared.value
        bound = Model(weights, thresholds)
        special = [float(weights[_index(n)]) for n in FORMS]
        known: dict[str, float] = {}
        logs = np.log1p(np.arange(4096)).tolist()
        for batch in batches:
            scores = []
            for cell in batch.column(at):
                words, forms = counted(cell.as_py())
                total, norm = 0.0, 0.0
                for word, n in words.items():
                    w = known.get(word)
                    if w is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        w = known[word] = float(weights[word_features(word)].sum())
                    v = logs[n] if n < 4096 else float(np.log1p(n))
                    total += v * w
                    norm += v * v
                form = sum(share * w for share, w in zip(forms, special, strict=True))
                scores.append(total / max(norm, 1.0) ** 0.5 + form)
            tails = bound.tails(np.array(scores, dtype=float).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails.sum(1)), pa.array(tails.tolist(), pa.list_(pa.float64())), pa.array(tails[:, -1] >= KEEP)],
                names=[*batch.schema.names, "__expected", "__tails", "__kept"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, __expected double, __tails array<double>, __kept boolean")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, rated(table(spark, sf_dir, "labels")))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.round("__expected", 6).alias("expected_grade"),
        *[F.round(F.col("__tails")[k - 1], 6).alias(f"p_grade_ge_{k}") for k in range(1, GRADES)],
        F.col("__kept").alias("kept"),
    )
