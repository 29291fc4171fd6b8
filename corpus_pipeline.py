"""A corpus preparation pipeline over ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last keep the columns of ``documents``.

Nulls and edges: a row without a doc_id or text goes through all stages (a null
text has no words; equal rows without an id collapse like others only if they have
an id). Blank texts are near duplicates of each other. Repeated ids with different
texts stay apart. Extra columns of the input end at the first stage, whatever their
names. Empty tables give no rows; without labels or benchmark items nothing goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.llm import decontam, jaccard, ordinal, packing, pii
from kelpline.llm.common import small_side, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose chance of the best grade reaches the classifier's threshold."""
    model = ordinal.fit(docs, ordinal.rated(table(spark, sf_dir, "labels")))
    return ordinal.score(docs, model).where("__kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the one with the smallest id. Rows without an id stay."""
    found = jaccard.near_duplicates(docs)
    gone = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    kept = docs.join(small_side(gone), F.col("doc_id") == F.col("__gone"), "left_anti")
    copies = kept.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    repeated = small_side(written(copies, "repeated"))
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts sanitised."""
    texts = pii.sanitise(docs)
    return texts.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of each chunk of each row."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", pack),
]

#: The classifier is trained and the fingerprints need XXH64: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
