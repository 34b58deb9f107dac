"""Training-corpus pipeline over the ``documents`` table.

Each stage is a function of (spark, docs, sf_dir) that applies one operator of
``linecraft.llm`` with production parameters to everything the stage before it
kept. A stage's result is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``; a null or empty
text passes through a stage unless the classifier rejects it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecraft.llm import byte_cnn, fm_index, packing, secrets, superminhash
from linecraft.llm._common import release, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose probability of good quality is under 0.3.

    Learns from labelled rows whose crc32 of the doc_id leaves a remainder
    other than 0 by 5, as the classifier's own query does.
    """
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    learn = labels.where(byte_cnn.remainder(F.col("doc_id"), 5) != 0)
    return byte_cnn.keep(docs, byte_cnn.fit(docs, learn))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: shingles of five words, similarity 0.8."""
    return superminhash.deduplicate(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item,
    or a whole shorter item."""
    return fm_index.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars``, where there, follows."""
    out = secrets.redact(docs)
    if "n_chars" in out.columns:
        size = F.length("text").cast(out.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of all remaining documents into sequences of 1024."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        docs = stored(out, "documents")
        release(before)
        before = docs
    return docs


#: No SQL expresses the classifier; stages are tested against brute force.
ORACLE_SQL = None
