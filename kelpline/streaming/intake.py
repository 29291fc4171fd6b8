"""Streaming extension: new rows matched as they arrive; automation rates per window.

The catalogue is static. Each micro-batch runs the cascade; exact duplicates of
a row within the watermark are matched once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.operators import match


def deduplicated(stream: DataFrame, time_col: str = "ts", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(["code", "desc"])


def matched(stream: DataFrame, ref: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, **options):
    """Starts a query that passes each batch's cascade results to ``sink``. ``checkpoint`` is a shared folder."""

    def each(batch: DataFrame, number: int) -> None:
        sink(match.cascade(batch, ref, **options), number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def automation(results: DataFrame, time_col: str = "ts", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, n, automated, rate) over tumbling windows; batch or streaming."""
    rows = results.withWatermark(time_col, late) if results.isStreaming else results
    grouped = rows.groupBy(F.window(time_col, width).alias("w")).agg(F.count("*").alias("n"), F.count_if(~F.col("needs_review")).alias("automated"))
    return grouped.select(F.col("w.start").alias("window_start"), "n", "automated", (F.col("automated") / F.col("n")).alias("rate"))
