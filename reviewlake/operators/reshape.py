"""Projections, decoding and reshaping.

Everything here is a narrow transformation (select / explode / struct paths): no shuffle, fully
pipelined inside one whole-stage-codegen stage, and column pruning reaches the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import misc
from reviewlake.functions import text as tx


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- payload explosion

def explode_reviews(df: DataFrame, keep: Sequence[str] = ("product_id",)) -> DataFrame:
    """Review page ``{data: [review...]}`` -> one row per review (review fields flattened)."""
    keep = [k for k in keep if k in df.columns]
    return df.select(*keep, F.explode("data").alias("r")).select(*keep, "r.*")


def explode_listing(df: DataFrame, keep: Sequence[str] = ("category", "page")) -> DataFrame:
    """S3: listing page ``{data: [{id}]}`` -> product ids."""
    keep = [k for k in keep if k in df.columns]
    return df.select(*keep, F.explode("data").alias("d")).select(*keep, F.col("d.id").alias("id"))


def explode_categories(df: DataFrame) -> DataFrame:
    """Category payload ``{items: [{id, name}]}`` -> (id, name)."""
    return df.select(F.explode("items").alias("i")).select("i.id", "i.name")


def enumerate_pages(df: DataFrame, first, last_col: str, out: str = "page") -> DataFrame:
    """Pages ``first..last`` inclusive per row (none when last < first; ``sequence`` alone
    would count down)."""
    lo = F.lit(first) if not isinstance(first, Column) else first
    hi = F.col(last_col).cast("int")
    pages = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, F.explode(pages))


# ---------------------------------------------------------------- documents

PRODUCT_DOCUMENT_FIELDS: tuple[tuple[str, str], ...] = (
    ("key", "key"), ("id", "id"), ("name", "name"), ("price", "price"), ("time", "time"),
    ("original_price", "original_price"), ("all_time_quantity_sold", "all_time_quantity_sold"),
    ("rating_average", "rating_average"), ("review_count", "review_count"),
    ("favourite_count", "favourite_count"), ("day_ago_created", "day_ago_created"),
    ("description", "description"), ("store_id", "current_seller.store_id"),
    ("is_best_store", "current_seller.is_best_store"), ("seller_name", "current_seller.name"),
    ("seller_price", "current_seller.price"), ("brand_id", "brand.id"), ("brand_name", "brand.name"),
    ("category_id", "categories.id"), ("category_name", "categories.name"),
    ("category_parent_id", "categories.parent_id"), ("category_parent_name", "categories.parent_name"),
)


# The header of the product export.
PRODUCT_EXPORT_FIELDS = (
    "product_id", "name", "price", "original_price", "all_time_quantity_sold", "rating_average", "review_count",
    "favourite_count", "day_ago_created", "description", "store_id", "seller_name", "seller_price", "is_best_store",
    "brand_id", "brand_name", "category_id", "category_name", "is_leaf", "category_parent_id", "category_parent_name",
)


def product_document(df: DataFrame) -> DataFrame:
    """Product row -> 22-field flat document."""
    return df.select(*[F.col(path).alias(name) for name, path in PRODUCT_DOCUMENT_FIELDS])


def product_export(df: DataFrame, sentence: str | None = None) -> DataFrame:
    """Product row -> 21-field export: ``product_id`` first, the description cleaned (N3), the leaf flag
    before the parent category. ``time`` and the row key are left out."""
    path = dict(PRODUCT_DOCUMENT_FIELDS)
    text = tx.clean_boilerplate("description", sentence) if sentence else tx.clean_safe("description")
    special = {"product_id": F.col(path["id"]), "description": text, "is_leaf": F.col("categories.is_leaf")}
    return df.select(*[special.get(n, F.col(path.get(n, "id"))).alias(n) for n in PRODUCT_EXPORT_FIELDS])


def product_slim(df: DataFrame, sentence: str | None = None) -> DataFrame:
    """(id, name, category, rating_average, description, seller), description cleaned."""
    desc = tx.clean_boilerplate("description", sentence) if sentence else tx.clean_safe("description")
    return df.select("id", "name", F.col("categories.parent_name").alias("category"), "rating_average",
                     desc.alias("description"), F.col("current_seller.name").alias("seller"))


def rating_document(df: DataFrame) -> DataFrame:
    """P5: review -> (id, title, content, customer_id, rating)."""
    return df.select("id", "title", "content", "customer_id", "rating")


def overview_document(df: DataFrame, stars_col: str = "stars", stars: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Star map {"1".."5" -> {count, percent}} -> stars_{n}_count / stars_{n}_percent.
    A star missing from the map gives NULL (the document simply lacks the field)."""
    flat = []
    for n in stars:
        entry = F.try_element_at(F.col(stars_col), F.lit(str(n)))
        flat += [entry.getField("count").alias(f"stars_{n}_count"),
                 entry.getField("percent").alias(f"stars_{n}_percent")]
    return df.select("product_id", "name_product", *flat, "rating_average", "reviews_count", "review_photo")


def map_to_columns(df: DataFrame, map_col: str, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """V8: selected map keys -> columns."""
    return df.select("*", *[F.try_element_at(F.col(map_col), F.lit(k)).alias(f"{prefix}{k}") for k in keys])


# ---------------------------------------------------------------- stamping and defaults

def stamp_date(df: DataFrame, date: str | None = None, col: str = "time") -> DataFrame:
    """Snapshot date as ``yyyy-MM-dd`` text; default today."""
    d = F.lit(date) if date else misc.day(F.current_date())
    return df.withColumn(col, d)


def snapshot_key(df: DataFrame, date_col: str = "time", id_col: str = "id", out: str = "key") -> DataFrame:
    """P10: composite key ``{date}_{id}``."""
    return df.withColumn(out, F.concat_ws("_", F.col(date_col).cast("string"), F.col(id_col).cast("string")))


def pick_fields(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Keep the named fields, missing values replaced by the given default."""
    return df.select(*[F.coalesce(F.col(f), F.lit(v)).alias(f) if v is not None else F.col(f)
                       for f, v in defaults.items()])


def default_struct(df: DataFrame, col: str, value: Mapping[str, object]) -> DataFrame:
    """An empty / null struct becomes the given default struct."""
    dflt = F.struct(*[F.lit(v).alias(k) for k, v in value.items()])
    cur = F.col(col)
    empty = cur.isNull() | F.col(f"{col}.{next(iter(value))}").isNull()
    return df.withColumn(col, F.when(empty, dflt).otherwise(cur))


def zero_if_null(df: DataFrame, col: str) -> DataFrame:
    """Null / missing count -> 0."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(0)))


def stamp_parent(df: DataFrame, parent_id, parent_name) -> DataFrame:
    """Stamp the driving listing category as parent into ``categories``."""
    return df.withColumn("categories", F.col("categories")
                         .withField("parent_id", _c(parent_id))
                         .withField("parent_name", _c(parent_name)))


# ---------------------------------------------------------------- review payload

def normalize_review(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Review defaults and nested author fields; ``score := float(rating)``.

    A missing author, or one without id, gets id 0 (an explicit null id is dropped before, P16);
    ``purchased_at`` null -> 0; summary fields flattened.
    """
    a = F.col("created_by")
    summ = F.col("created_by.contribute_info.summary")
    author = F.struct(
        F.coalesce(a.getField("id"), F.lit(0).cast("long")).alias("id"),
        F.coalesce(a.getField("name"), F.lit("")).alias("name"),
        F.coalesce(a.getField("full_name"), F.lit("")).alias("full_name"),
        F.coalesce(summ.getField("joined_time"), F.lit("")).alias("joined_time"),
        F.coalesce(a.getField("region"), F.lit("")).alias("region"),
        F.coalesce(a.getField("avatar_url"), F.lit("")).alias("avatar_url"),
        F.coalesce(a.getField("created_time"), F.lit("")).alias("created_time"),
        F.coalesce(a.getField("group_id"), F.lit(0).cast("long")).alias("group_id"),
        a.getField("purchased").alias("purchased"),
        F.coalesce(a.getField("purchased_at"), F.lit(0).cast("long")).alias("purchased_at"),
        F.coalesce(summ.getField("total_review"), F.lit(0).cast("long")).alias("total_review"),
        F.coalesce(summ.getField("total_thank"), F.lit(0).cast("long")).alias("total_thank"),
    )
    return df.select(
        *keep, "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("content", F.lit("")).alias("content"),
        F.coalesce("status", F.lit("")).alias("status"), F.coalesce("thank_count", F.lit(0).cast("long")).alias("thank_count"),
        F.col("rating").cast("double").alias("score"), "new_score", "customer_id",
        F.coalesce("comment_count", F.lit(0).cast("long")).alias("comment_count"), "rating",
        F.coalesce("images", F.array().cast("array<struct<id:bigint,full_path:string,status:string>>")).alias("images"),
        "timeline", author.alias("created_by"),
    )


def normalize_review_payload(df: DataFrame, payload_col: str = "v", keep: Sequence[str] = ()) -> DataFrame:
    """P15 on the raw payload (VARIANT): as ``normalize_review``, but a field that is absent gets its default ('' or 0), while
    an explicit null stays null. Only ``purchased_at`` and a null author count as absent. ``purchased`` is text:
    'true', 'false', or '' where it is absent."""
    def field(path: str, kind: str, default) -> Column:
        value = F.expr(f"try_variant_get({payload_col}, '$.{path}', '{kind}')")
        null = F.coalesce(F.expr(f"is_variant_null(variant_get({payload_col}, '$.{path}'))"), F.lit(False))
        return F.when(~null, F.coalesce(value, F.lit(default).cast(kind)))

    by, summary = "created_by", "created_by.contribute_info.summary"
    text = {n: field(f"{by}.{n}", "string", "") for n in ("name", "full_name", "region", "avatar_url", "created_time", "purchased")}
    number = {n: field(f"{by}.{n}", "bigint", 0) for n in ("id", "group_id")}
    author = {
        "id": number["id"], "name": text["name"], "full_name": text["full_name"], "joined_time": field(f"{summary}.joined_time", "string", ""),
        "region": text["region"], "avatar_url": text["avatar_url"], "created_time": text["created_time"], "group_id": number["group_id"],
        "purchased": text["purchased"], "purchased_at": F.coalesce(field(f"{by}.purchased_at", "bigint", 0), F.lit(0).cast("long")),
        "total_review": field(f"{summary}.total_review", "bigint", 0), "total_thank": field(f"{summary}.total_thank", "bigint", 0)}
    images = F.expr(f"try_variant_get({payload_col}, '$.images', 'array<struct<id:bigint,full_path:string,status:string>>')")
    rating = field("rating", "double", 0.0)
    return df.select(
        *keep, field("id", "bigint", 0).alias("id"), *[field(n, "string", "").alias(n) for n in ("title", "content", "status")],
        *[field(n, "bigint", 0).alias(n) for n in ("thank_count", "customer_id", "comment_count")],
        rating.alias("rating"), rating.alias("score"), F.coalesce(images, F.array().cast(
            "array<struct<id:bigint,full_path:string,status:string>>")).alias("images"),
        F.struct(*[c.alias(n) for n, c in author.items()]).alias("created_by"))


def drop_null_author(df: DataFrame, payload_col: str = "v", path: str = "$.created_by.id") -> DataFrame:
    """Drop reviews whose author id is an explicit JSON null (an absent id stays: it becomes 0).

    Needs the raw payload as VARIANT (``parse_json``); ``from_json`` cannot tell null from absent.
    """
    explicit_null = F.coalesce(F.expr(f"is_variant_null(variant_get({payload_col}, '{path}'))"), F.lit(False))
    return df.filter(~explicit_null)


def explode_images(df: DataFrame, key: str = "id", col: str = "images") -> DataFrame:
    """Images array -> (key, index, image fields)."""
    return (df.select(key, F.posexplode(col).alias("idx", "img"))
            .select(key, "idx", "img.*"))


def explode_specs(df: DataFrame, key: str = "id") -> DataFrame:
    """Specifications -> one map per product ``"{spec}:{attr}" -> value``; a repeated
    (spec, attr) keeps the last value."""
    specs = (df.select(key, F.posexplode("specifications").alias("si", "s"))
             .select(key, "si", F.col("s.name").alias("spec"), F.posexplode("s.attributes").alias("ai", "a"))
             .select(key, "si", "ai", F.concat_ws(":", "spec", F.col("a.code")).alias("k"),
                     F.col("a.value").alias("value")))
    last = specs.groupBy(key, "k").agg(F.max_by("value", F.struct("si", "ai")).alias("value"))
    return last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("specs"))


def product_names(df: DataFrame, id_col: str = "id", name_col: str = "name",
                  phrases: Sequence[str] = tx.NAME_PHRASES) -> DataFrame:
    """(id, cleaned name)."""
    return df.select(id_col, tx.clean_name(name_col, phrases).alias(name_col))


def metadata_text(name, category, sentence: str | None = None, null_safe: bool = False) -> Column:
    """clean(name) + ' ' + category + ' ' (``concat`` propagates a null category;
    ``null_safe=True`` uses ``concat_ws`` instead)."""
    cleaned = tx.clean_product(name, sentence)
    if null_safe:
        return F.concat(F.concat_ws(" ", cleaned, _c(category)), F.lit(" "))
    return F.concat(cleaned, F.lit(" "), _c(category), F.lit(" "))


def join_title(title, content) -> Column:
    """Title + ' ' + content (null-propagating)."""
    return F.concat(_c(title), F.lit(" "), _c(content))


# ---------------------------------------------------------------- wide-row cells

def to_cells(df: DataFrame, key: str, columns: Sequence[str] | None = None, family: str | None = None) -> DataFrame:
    """Wide row -> (row_key, column, value) records (``unpivot``; values as text)."""
    cols = [c for c in (columns or df.columns) if c != key]
    casted = df.select(F.col(key).alias("row_key"), *[F.col(c).cast("string").alias(c) for c in cols])
    out = casted.unpivot("row_key", cols, "column", "value")
    if family:
        out = out.withColumn("column", F.concat(F.lit(f"{family}:"), F.col("column")))
    return out


def cells_to_map(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells ``{prefix}:{a}:{b}`` -> per row key a map ``a -> map(b -> value)``.

    Each group is one row's cells (bounded by the row width), never a whole table.
    """
    parts = F.split(F.col("column"), ":", 3)
    inner = (cells.filter(F.col("column").startswith(prefix + ":"))
             .select("row_key", parts.getItem(1).alias("a"), parts.getItem(2).alias("b"), "value")
             .filter(F.col("b").isNotNull())
             .groupBy("row_key", "a").agg(F.map_from_entries(F.collect_list(F.struct("b", "value"))).alias("m")))
    return inner.groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("a", "m"))).alias(prefix))


def decode_key(c, four_byte: Column | None = None) -> Column:
    """Row key as 4-byte big-endian int or decimal text (binary input).

    A 4-byte key is ambiguous with 4-digit text; ``four_byte`` (boolean column) decides when given.
    """
    c = _c(c)
    as_int = F.conv(F.hex(c), 16, 10).cast("long")
    signed = F.when(as_int >= F.lit(2 ** 31), as_int - F.lit(2 ** 32)).otherwise(as_int)
    txt = c.cast("string").try_cast("long")
    is4 = four_byte if four_byte is not None else (F.octet_length(c) == 4)
    return F.when(is4, signed).otherwise(txt)
