"""A corpus in five stages: language, exact copies, near copies, mixture, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder and reads it again as the next stage's docs. All stages but the last return
rows of ``documents`` with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import lang_crf, mixing, ngram_join, packing, stream_dedup
from reviewlake.session import cut_lineage, ship_package

#: A text whose likeliest language has a smaller share than this is in no learned language.
MIN_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; texts without one (``und``, or no clear language) go."""
    ship_package(spark)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    found = lang_crf.learn_and_predict(docs, learn)
    return found.where((F.col("lang_pred") != lang_crf.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row that stays."""
    ship_package(spark)
    return stream_dedup.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources emits it, at least once."""
    ship_package(spark)
    return mixing.mix_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [("language ID", language), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing sources", mixture), ("packing", packed)]

#: The stages learn, hash and tokenise; SQL can't express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
