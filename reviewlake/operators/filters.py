"""Row filters (F1-F11). All are plain ``filter`` / semi / anti joins so Catalyst can push them down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.text import WS_CHARS
from reviewlake.session import cut_lineage


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """drop null content and content made only of whitespace."""
    return df.filter(F.col(col).isNotNull() & F.col(col).rlike(f"[^{WS_CHARS}]"))


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    """drop rows whose (cleaned) text is empty."""
    return df.filter(F.col(col) != "")


def known_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """keep rows whose label is not 'Unknown'."""
    return df.filter(F.col(col) != "Unknown")


def has_tokens(df: DataFrame, col: str = "tokens") -> DataFrame:
    """non-empty token list."""
    return df.filter(F.size(col) > 0)


def exclude_name(df: DataFrame, name_col: str, query_col: str) -> DataFrame:
    """drop hits equal to the query (null-safe)."""
    return df.filter(~F.col(name_col).eqNullSafe(F.col(query_col)))


def pairs_of(df: DataFrame, id_value, id1: str = "id1", id2: str = "id2") -> DataFrame:
    """rows of one left id, self pair excluded."""
    return df.filter((F.col(id1) == F.lit(id_value)) & (F.col(id2) != F.lit(id_value)))


def find_product(df: DataFrame, name_col: str, text: str, id_col: str = "id") -> DataFrame:
    """the product whose name contains ``text``; ties -> smallest id. One row or none."""
    hits = df.filter(F.contains(F.col(name_col), F.lit(text)))
    return hits.agg(F.min(id_col).alias(id_col)).filter(F.col(id_col).isNotNull())


def skip_done(df: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Anti-join with a done list (the optimizer picks broadcast when the list is small)."""
    return df.join(done, on=key, how="left_anti")


def resume_after(df: DataFrame, order_col: str, key_col: str, cursor) -> DataFrame:
    """skip rows (in ``order_col`` order) before the first row whose key is ``cursor``.

    ``cursor=None`` keeps every row; an unknown cursor keeps none. The position of the cursor is a
    scalar subquery, so no data passes through the driver.
    """
    if cursor is None:
        return df
    start = df.filter(F.col(key_col) == F.lit(cursor)).select(F.min(order_col)).scalar()
    return df.filter(F.col(order_col) >= start)


def take_until(df: DataFrame, order_col: str, key_col: str, key) -> DataFrame:
    """rows up to and including the first row whose key is ``key``; unknown key -> all rows."""
    stop = df.filter(F.col(key_col) == F.lit(key)).select(F.min(order_col)).scalar()
    return df.filter(stop.isNull() | (F.col(order_col) <= stop))


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """keep rows where every named column is present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


#: Rarest grams of a text that pick its candidates.
PROBED_GRAMS = 3


def _grams(text: Column, n: Column) -> Column:
    """Distinct substrings of n characters (none for a shorter text)."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))


def find_products(products: DataFrame, queries: DataFrame, name_col: str, text_col: str = "text", id_col: str = "id",
                  qid_col: str = "qid") -> DataFrame:
    """F7 for a table of texts: (qid, id) of the product with the smallest id whose name contains the text.

    Names are posted under their trigrams; a text meets the postings of its rarest grams only, a name must stand in all of
    these, and ``contains`` decides. Texts of one or two characters use grams of their own length. An empty text is in every
    name; a null text, or one that no name contains, finds nothing. Equal texts are searched once, and of products with
    equal names only the smallest id can be found.
    """
    names = cut_lineage(products.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("name")).agg(F.min(id_col).alias("found"))
                        .where("found IS NOT NULL").withColumn("id", F.monotonically_increasing_id()), "product-names")
    asking = cut_lineage(queries.select(F.col(qid_col).alias("_qid"), F.col(text_col).alias("text")).where("text IS NOT NULL"), "query-texts")
    texts = cut_lineage(asking.select("text").distinct().withColumns({
        "n": F.least(F.length("text"), F.lit(3)), "qid": F.monotonically_increasing_id()}), "distinct-texts")
    sizes = sorted(r.n for r in texts.select("n").distinct().collect())                       # 0 to 3
    empty = asking.where("text = ''").select(F.col("_qid").alias("qid")).join(
        F.broadcast(names.agg(F.min("found").alias("id")).where("id IS NOT NULL")))
    sizes = [n for n in sizes if n]
    if not sizes:
        return empty.select("qid", "id")
    postings = cut_lineage(names.select("id", F.explode(F.flatten(F.array(*[_grams(F.col("name"), F.lit(n)) for n in sizes]))).alias("gram")),
                           "name-grams")
    asked = texts.where("n > 0").select("qid", F.explode(_grams(F.col("text"), F.col("n"))).alias("gram"))
    rows = postings.join(asked.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    rarest = Window.partitionBy("qid").orderBy(F.coalesce("df", F.lit(0)), "gram")
    probes = asked.join(rows, "gram", "left").withColumn("place", F.row_number().over(rarest)).where(F.col("place") <= PROBED_GRAMS)
    probes = probes.withColumn("wanted", F.count(F.lit(1)).over(Window.partitionBy("qid"))).select("qid", "gram", "wanted")
    candidates = (postings.join(probes, "gram").groupBy("qid", "id").agg(F.count(F.lit(1)).alias("met"), F.max("wanted").alias("wanted"))
                  .where("met = wanted"))
    found = candidates.join(names, "id").join(texts.select("qid", "text"), "qid").where(F.contains("name", "text"))
    hits = found.groupBy("qid").agg(F.min("found").alias("id")).join(texts.select("qid", "text"), "qid").select("text", "id")
    return (asking.join(hits, "text").groupBy(F.col("_qid").alias("qid")).agg(F.min("id").alias("id"))
            .unionByName(empty.select("qid", "id")))
