"""From raw documents to shards: each stage applies one operator to all rows that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, mixing, quality, sharding, simhash
from tidewatch.llm.common import aside, attach, read_table, scratch_path, ship, words

#: No stage can be put into SQL as a whole; stages are tested against brute-force versions.
ORACLE_SQL: str | None = None

SHARDS = 40
REJECTED_BELOW = 0.5
#: What stages read of a document; other columns, whatever their names, are carried beside it.
DOCUMENT = ["doc_id", "text", "source", "lang"]


def row_key() -> list[Column]:
    """Tells rows apart: id, checksum and size of the text, source and language."""
    return [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit(""))), F.coalesce(F.octet_length("text"), F.lit(0)), F.col("source"), F.col("lang")]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees do not reject."""
    ship(spark)
    forest = quality.train(docs, read_table(spark, sf_dir, "labels"))
    plain, back = aside(docs, DOCUMENT)
    return back(quality.with_score(plain, forest, keep_text=True, score="__quality").where(F.col("__quality") >= REJECTED_BELOW))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    hits = found.select(F.col("digest").alias("__digest"), F.lit(True).alias("__hit")).distinct()
    plain, back = aside(docs, DOCUMENT)
    marked = decontaminate.with_digest(plain.withColumn("__row", F.xxhash64(*row_key())), "text").withColumnRenamed("digest", "__digest")
    return back(attach(marked, hits, ["__digest"], F.col("__row"), "left").where("__hit IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    ship(spark)
    plain, back = aside(docs, DOCUMENT)
    mixed = mixing.copies(plain, words(), row_key())
    return back(mixed.where("mix_copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``shard`` and ``slot`` of every row on a ring of 40 shards of equal row counts; columns of those names are replaced."""
    plain, back = aside(docs.drop("shard", "slot"), DOCUMENT)
    return back(sharding.assign(plain, row_key(), SHARDS), "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
