"""From raw documents to packed training sequences, in five stages.

Each stage is a function of the session, the documents its predecessor kept, and the
folder of the other tables; a caller may also say where it keeps tables of its own.
``run`` writes what a stage returns and hands the next one the table that it reads
back, so lost executors never cost more than a stage. What a stage kept for itself goes
when its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm import decontaminate, jaccard, language, packing, pii, secret_scan
from footfall.plans.scratch import Scratch


def identify_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """Drops documents without a language, and those between two."""
    found = language.identify(docs, language.fit_languages(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & ~F.col("lang_ambiguous")
    return found.where(known).select(docs.columns)


def drop_near_copies(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.one_of_each(docs, scratch=scratch)


def drop_benchmark(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, items, scratch=scratch)


def mask_personal_data(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """Personal data and secrets become the name of their kind; n_chars follows the text."""
    masked = pii.mask_personal_data(docs, secret_scan.make_finder())
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def pack(
    spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None
) -> DataFrame:
    """The pieces of all documents in sequences."""
    kept = scratch or Scratch(spark, "pack")
    return packing.pack(kept.keep(packing.tokenised(docs), "pieces"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Learnt languages, masked disguises and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The pieces, and beside them in ``folder`` the documents they are pieces of.

    ``personal_data`` and ``packing`` are the two tables that stay there; without a
    folder they are in a scratch folder. ``packing.sequences`` makes token ids of them.
    """
    kept = Scratch(spark, "pipeline", folder)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        inner = kept.part(name)
        docs = kept.keep(stage(spark, docs, sf_dir, inner), name)
        inner.drop()
        if before and name != STAGES[-1][0]:
            kept.forget(before)
        before = name
    return docs
