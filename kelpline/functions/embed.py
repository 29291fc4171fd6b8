"""Text embedders. Any object with ``vectors(Column) -> Column`` of unit array<double> can be injected.

Vectors are scaled to norm 1 in the worker that makes them (zero vectors stay), whatever the model returns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Embedder(Protocol):
    def vectors(self, text: Column) -> Column: ...


class HashedNgrams:
    """Hashed character n-grams of padded words, as unit vectors; the offline default."""

    def __init__(self, size: int = 256, low: int = 3, high: int = 5):
        self.size, self.low, self.high = size, low, high

    def vectors(self, text: Column) -> Column:
        size, low, high = self.size, self.low, self.high

        def encode(texts: pd.Series) -> list[list[float]]:
            out = []
            for t in texts:
                v = np.zeros(size)
                for w in (t or "").split():
                    p = f" {w} "
                    for n in range(low, min(high, max(len(p), low)) + 1):
                        for i in range(max(len(p) - n, 0) + 1):
                            v[zlib.crc32(p[i : i + n].encode()) % size] += 1.0
                norm = np.linalg.norm(v)
                out.append((v / norm if norm else v).tolist())
            return out

        @F.pandas_udf("array<double>")
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for b in batches:
                yield pd.Series(encode(b))

        return embed(text)


class FunctionEmbedder:
    """Wraps ``encode(list of texts) -> rows of numbers``; loaded once in each worker."""

    def __init__(self, make: Callable[[], Callable]):
        self.make = make

    def vectors(self, text: Column) -> Column:
        make = self.make

        @F.pandas_udf("array<double>")
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = make()
            for b in batches:
                rows = np.asarray(encode([t or "" for t in b]), dtype=float).reshape(len(b), -1)
                norms = np.linalg.norm(rows, axis=1, keepdims=True)
                yield pd.Series((rows / np.where(norms == 0, 1.0, norms)).tolist())

        return embed(text)


def embedded(embedder: Embedder, text: Column) -> Column:
    return embedder.vectors(text)
