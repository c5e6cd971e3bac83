"""File sources: landed JSON payloads, CSV exports, word lists, saved models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions.text import parse_bool
from reviewlake.functions.text import strip_ws


def read_products(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed product-detail payloads (one JSON document per line, explicit schema).

    Unparsable lines become all-null rows in PERMISSIVE mode and are dropped here (a failed API
    call produced no row in the source pipeline either)."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return df.filter(F.col(schema.fields[0].name).isNotNull())


def read_payloads(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed review / listing / category payloads with an explicit schema."""
    return spark.read.schema(schema).json(path)


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    """Raw payload lines as VARIANT (keeps explicit JSON null apart from an absent field)."""
    return spark.read.text(path).select(F.parse_json("value").alias("v"))


def read_csv_strings(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with header; every column a string (no inference pass over the data)."""
    return (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
            .csv(path))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (an extra pass; prefer an explicit schema at scale)."""
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)


PRODUCT_CSV_BOOLS = ("is_best_store", "is_leaf")


def read_product_csv(spark: SparkSession, path: str, bool_cols=PRODUCT_CSV_BOOLS,
                     types: dict[str, str] | None = None) -> DataFrame:
    """CSV rows -> documents: 'true' in any case -> true, anything else false; optional casts."""
    df = read_csv_strings(spark, path, multiline=True)
    for c in bool_cols:
        if c in df.columns:
            df = df.withColumn(c, parse_bool(c))
    for c, t in (types or {}).items():
        df = df.withColumn(c, F.col(c).try_cast(t))
    return df


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, stripped, blank lines dropped, each word once."""
    return (spark.read.text(path).select(strip_ws("value").alias("word"))
            .filter(F.col("word") != "").distinct())


def load_models(path: str):
    """A saved PipelineModel (see ``plans.sentiment.load_pipeline`` / ``load_word2vec``)."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
