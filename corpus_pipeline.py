"""The corpus pipeline: documents to balanced training shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet into the
shared folder and reads it again as the next stage's ``docs``, so a lost executor costs one stage at most.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, minhash, mixing, quality, sharding
from panelcast.llm.common import table
from panelcast.session import stage

KEEP_SCORE, NEAR_PERCENT, LEAK_PERCENT, SHARDS, SEED = 0.3, 80, 80, 24, 0


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learnt from all labels."""
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return docs.filter(model.score(F.col("text")) >= KEEP_SCORE)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs, percent=NEAR_PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), percent=LEAK_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The spans of documents that the mixture takes, each as often as it takes it."""
    return mixing.mix(docs, seed=SEED).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in balanced shards: its rows with ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    return sharding.byte_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Trained scores, hashed buckets and seeded draws have no SQL form; tests hold every stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
