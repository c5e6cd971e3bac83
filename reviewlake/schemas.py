"""Explicit schemas of the landed payloads and the flat documents (no inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, F32 = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.BooleanType(), T.FloatType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


SELLER = T.StructType([
    _f("id", L), _f("sku", S), _f("name", S), _f("link", S), _f("logo", S), _f("price", D),
    _f("product_id", S), _f("store_id", L), _f("is_best_store", B),
    _f("is_offline_installment_supported", B),
])
BRAND = T.StructType([_f("id", L), _f("name", S), _f("slug", S)])
CATEGORY = T.StructType([
    _f("id", L), _f("name", S), _f("is_leaf", B), _f("parent_id", L), _f("parent_name", S),
])
SPEC_ATTR = T.StructType([_f("code", S), _f("value", S)])
SPEC = T.StructType([_f("name", S), _f("attributes", T.ArrayType(SPEC_ATTR))])

# Product detail payload plus the fields the pipeline stamps on it (parent category, time, key).
PRODUCT = T.StructType([
    _f("id", L), _f("name", S), _f("short_url", S), _f("thumbnail_url", S), _f("description", S),
    _f("price", D), _f("original_price", D), _f("all_time_quantity_sold", L),
    _f("rating_average", D), _f("review_count", L), _f("favourite_count", L),
    _f("day_ago_created", L), _f("current_seller", SELLER), _f("brand", BRAND),
    _f("specifications", T.ArrayType(SPEC)), _f("categories", CATEGORY),
    _f("time", S), _f("key", S),
])

SUMMARY = T.StructType([_f("joined_time", S), _f("total_review", L), _f("total_thank", L)])
AUTHOR = T.StructType([
    _f("id", L), _f("name", S), _f("full_name", S), _f("region", S), _f("avatar_url", S),
    _f("created_time", S), _f("group_id", L), _f("purchased", B), _f("purchased_at", L),
    _f("contribute_info", T.StructType([_f("summary", SUMMARY)])),
])
IMAGE = T.StructType([_f("id", L), _f("full_path", S), _f("status", S)])
TIMELINE = T.StructType([
    _f("review_created_date", S), _f("delivery_date", S), _f("current_date", S),
    _f("content", S), _f("explain", S),
])
REVIEW = T.StructType([
    _f("id", L), _f("title", S), _f("content", S), _f("status", S), _f("thank_count", L),
    _f("score", D), _f("new_score", D), _f("customer_id", L), _f("comment_count", L),
    _f("rating", I), _f("images", T.ArrayType(IMAGE)), _f("timeline", TIMELINE),
    _f("created_by", AUTHOR),
])
STAR = T.StructType([_f("count", L), _f("percent", D)])
REVIEW_PHOTO = T.StructType([_f("total", L), _f("total_photo", L)])
REVIEW_PAGE = T.StructType([
    _f("product_id", L),
    _f("paging", T.StructType([_f("last_page", I)])),
    _f("stars", T.MapType(S, STAR)), _f("rating_average", D), _f("reviews_count", L),
    _f("review_photo", REVIEW_PHOTO), _f("data", T.ArrayType(REVIEW)),
])
LISTING_PAGE = T.StructType([_f("category", L), _f("page", L),
                             _f("data", T.ArrayType(T.StructType([_f("id", L)])))])
CATEGORY_PAYLOAD = T.StructType([_f("items", T.ArrayType(T.StructType([_f("id", L), _f("name", S)])))])

# Flat documents (index mappings).
PRODUCT_DOCUMENT = T.StructType([
    _f("key", S), _f("id", L), _f("name", S), _f("price", D), _f("time", S),
    _f("original_price", D), _f("all_time_quantity_sold", L), _f("rating_average", D),
    _f("review_count", L), _f("favourite_count", L), _f("day_ago_created", L),
    _f("description", S), _f("store_id", L), _f("is_best_store", B), _f("seller_name", S),
    _f("seller_price", D), _f("brand_id", L), _f("brand_name", S), _f("category_id", L),
    _f("category_name", S), _f("category_parent_id", L), _f("category_parent_name", S),
])
RATING_DOCUMENT = T.StructType([
    _f("id", L), _f("title", S), _f("content", S), _f("customer_id", L), _f("rating", I),
])
OVERVIEW_DOCUMENT = T.StructType(
    [_f("product_id", L), _f("name_product", S)]
    + [_f(f"stars_{n}_count", L) for n in range(1, 6)]
    + [_f(f"stars_{n}_percent", D) for n in range(1, 6)]
    + [_f("rating_average", D), _f("reviews_count", L), _f("review_photo", REVIEW_PHOTO)]
)
