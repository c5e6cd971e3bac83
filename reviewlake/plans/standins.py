"""Bindings of the domain entities to the given tables (all derived by Spark from those tables).

product   = part + its latest lineitem's supplier (seller) + nation (category) + region (parent)
review    = documents (title = first line, rating = doc_id % 6, 0 gives the Unknown label)
star rows = lineitem (rating = 1 + int(l_quantity) % 5, product = l_partkey)
messages  = events (id = user_id, name = event_type)
vectors   = embeddings
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import misc
from reviewlake.functions import text as tx
from reviewlake.session import spread
from reviewlake.sources.tables import table

REVIEW_PAGE_SIZE = 20      # reviews per review page (fixed by the source API)
LISTING_PAGE_SIZE = 100    # products per listing page (fixed by the source API)


def reviews(documents: DataFrame) -> DataFrame:
    """Flat review rows: id, title, content, customer_id, rating (int)."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.col("doc_id").alias("customer_id"),
        (F.col("doc_id") % 6).cast("int").alias("rating"),
    )


def review_pages(documents: DataFrame) -> DataFrame:
    """Landed review-page payloads ``{product_id, data: [review...]}``; one page per
    ``doc_id div 20`` (so each collected group holds at most 20 reviews)."""
    review = F.struct(
        F.col("doc_id").alias("id"), F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"), F.lit("approved").alias("status"),
        F.lit(None).cast("long").alias("thank_count"), F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("double").alias("new_score"), F.col("doc_id").alias("customer_id"),
        F.lit(None).cast("long").alias("comment_count"), (F.col("doc_id") % 6).cast("int").alias("rating"),
        F.lit(None).cast(schemas.REVIEW["images"].dataType).alias("images"),
        F.lit(None).cast(schemas.TIMELINE).alias("timeline"),
        F.struct(F.col("doc_id").alias("id"), F.col("source").alias("name"), F.lit(None).cast("string").alias("full_name"),
                 F.col("lang").alias("region"), F.lit(None).cast("string").alias("avatar_url"),
                 F.lit(None).cast("string").alias("created_time"), F.lit(None).cast("long").alias("group_id"),
                 F.lit(True).alias("purchased"), F.lit(None).cast("long").alias("purchased_at"),
                 F.lit(None).cast(schemas.AUTHOR["contribute_info"].dataType).alias("contribute_info"),
                 ).alias("created_by"),
    )
    return (documents.groupBy(F.floor(F.col("doc_id") / REVIEW_PAGE_SIZE).cast("long").alias("product_id"))
            .agg(F.collect_list(review).alias("data")))


def star_rows(lineitem: DataFrame) -> DataFrame:
    """One star rating per line: (product_id, star)."""
    return lineitem.select(F.col("l_partkey").alias("product_id"),
                           (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("star"))


def star_overview(lineitem: DataFrame) -> DataFrame:
    """Per product: stars map {"1".."5" -> {count, percent}}, rating_average, reviews_count.

    Two hash aggregations: (product, star) counts, then per product. The second groups at most five
    rows per product, so ``map_from_entries(collect_list)`` never holds an unbounded group.
    """
    per_star = star_rows(lineitem).groupBy("product_id", "star").agg(F.count(F.lit(1)).alias("cnt"))
    return (per_star.groupBy("product_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("star").cast("string"),
                                                   F.struct(F.col("cnt").alias("count"),
                                                            F.col("cnt").cast("double").alias("percent")))))
        .alias("_m"),
        F.sum("cnt").alias("reviews_count"),
        F.sum(F.col("star") * F.col("cnt")).alias("_star_sum"))
        .select("product_id",
                F.transform_values("_m", lambda k, v: v.withField(
                    "percent", v.getField("count") * 100.0 / F.col("reviews_count"))).alias("stars"),
                (F.col("_star_sum") / F.col("reviews_count")).alias("rating_average"),
                "reviews_count",
                F.struct(F.col("reviews_count").alias("total"), F.lit(0).cast("long").alias("total_photo"))
                .alias("review_photo")))


def product_rows(spark: SparkSession, base: str) -> DataFrame:
    """Product payload rows (schema ``schemas.PRODUCT``) derived from part/lineitem/supplier/nation/region.

    The seller is the supplier of the part's latest line (``max_by``: partial aggregation, no sort).
    The dimension joins are left to Catalyst/AQE (broadcast when the dimension is small).
    """
    part = spread(table(spark, base, "part"), "p_partkey")
    li = table(spark, base, "lineitem")
    stats = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max_by(F.struct("l_suppkey", "l_shipdate"), F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("last"),
        F.sum("l_quantity").cast("long").alias("sold"),
        F.count(F.lit(1)).alias("n_lines"),
        F.avg(F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("avg_star"))
    sup = table(spark, base, "supplier")
    nat = table(spark, base, "nation")
    reg = table(spark, base, "region")
    p = (part.join(stats, "p_partkey", "left")
         .join(sup, F.col("s_suppkey") == F.col("last.l_suppkey"), "left")
         .join(nat, F.col("n_nationkey") == F.col("s_nationkey"), "left")
         .join(reg, F.col("r_regionkey") == F.col("n_regionkey"), "left"))
    raw_html = F.concat(F.lit("<div><p>"), F.col("p_name"), F.lit(" &amp; "), F.col("p_type"),
                        F.lit("</p><br>size "), F.col("p_size").cast("string"), F.lit("</div>"))
    time = misc.day("last.l_shipdate")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.concat(F.lit("p/"), F.col("p_partkey").cast("string")).alias("short_url"),
        F.lit(None).cast("string").alias("thumbnail_url"),
        tx.html_text(raw_html).alias("description"),
        F.col("p_retailprice").alias("price"), F.col("p_retailprice").alias("original_price"),
        F.col("sold").alias("all_time_quantity_sold"),
        F.col("avg_star").alias("rating_average"), F.col("n_lines").alias("review_count"),
        F.col("p_size").cast("long").alias("favourite_count"), F.lit(None).cast("long").alias("day_ago_created"),
        F.struct(F.col("s_suppkey").alias("id"), F.lit(None).cast("string").alias("sku"), F.col("s_name").alias("name"),
                 F.lit(None).cast("string").alias("link"), F.lit(None).cast("string").alias("logo"),
                 F.col("p_retailprice").alias("price"), F.col("p_partkey").cast("string").alias("product_id"),
                 F.col("s_suppkey").alias("store_id"), (F.col("s_acctbal") > 0).alias("is_best_store"),
                 F.lit(False).alias("is_offline_installment_supported")).alias("current_seller"),
        F.struct(F.regexp_extract("p_brand", r"#(\d+)", 1).try_cast("long").alias("id"), F.col("p_brand").alias("name"),
                 F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("slug")).alias("brand"),
        F.array(F.struct(F.lit("shape").alias("name"),
                         F.array(F.struct(F.lit("type").alias("code"), F.col("p_type").alias("value")),
                                 F.struct(F.lit("size").alias("code"),
                                          F.concat(F.lit("<b>"), F.col("p_size").cast("string"), F.lit("</b>\\n")).alias("value")))
                         .alias("attributes"))).alias("specifications"),
        F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.lit(True).alias("is_leaf"),
                 F.col("r_regionkey").cast("long").alias("parent_id"), F.col("r_name").alias("parent_name")).alias("categories"),
        time.alias("time"),
        F.concat_ws("_", time, F.col("p_partkey").cast("string")).alias("key"),
    )


def messages(events: DataFrame) -> DataFrame:
    """Category messages (id, name) with their event time and offset-like ordering."""
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                         F.col("user_id").alias("id"), F.col("event_type").alias("name"))
