"""Registered queries: one per operator family of the inventory, each reading the given tables.

Every callable takes ``(spark, base_dir)`` and returns a lazy DataFrame over whole tables.
Column names equal the matching oracle SQL in ``reviewlake.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import misc
from reviewlake.functions import text as tx
from reviewlake.functions import vectors as vx
from reviewlake.operators import aggs, filters, joins, reshape, sparse_topn, topk
from reviewlake.operators import upsert as up
from reviewlake.plans import recommend, standins
from reviewlake.session import cut_lineage, spread
from reviewlake.sources.tables import lookup, scan, table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (not data subsets: each is the operator's own argument).
RANGE_START_KEY = 7500          # S12 range scan start key
RANGE_LIMIT = 1000              # S12 rows per range scan
FIRST_N = 20                    # S11 first rows in key order
CURSOR_CUSTOMER = 700           # F9/F10 cursor key
HISTORY_CUTOFF = "2024-01-04"   # J7 messages before this time are the already-sent history
DONE_CUTOFF = "2024-01-02"      # F8 users with an error before this time are on the done list
STOPWORDS_TOP = 50              # N12 stop words = the most frequent words
KNN_K = 20                      # T3 neighbours per query
COSINE_K = 5                    # T2 top-n by cosine
TFIDF_TOP = 10                  # T1 / M7 recommendations per product
RECOMMEND_TEXT = "blue bolt"    # M7 product text to look up
MATCH_WORD = "and"              # D4 word searched in descriptions


def _docs(spark, base, cols=("doc_id", "text")):
    return spread(table(spark, base, "documents").select(*cols), "doc_id")


# ------------------------------------------------------------------ step 0: minimum slice

def label_counts(spark: SparkSession, base: str) -> DataFrame:
    """Reviews per sentiment label."""
    r = filters.drop_blank(_docs(spark, base), "text")
    r = r.withColumn("clean", tx.clean_base("text"))
    r = filters.drop_empty(r, "clean").withColumn("label", tx.label_from_rating(F.col("doc_id") % 6))
    return aggs.label_counts(filters.known_labels(r))


# ------------------------------------------------------------------ sources and payloads

def reviews_exploded(spark, base):
    """S2 + P15: review pages -> review rows, normalised."""
    pages = standins.review_pages(_docs(spark, base, ("doc_id", "text", "lang", "source")))
    rows = reshape.normalize_review(reshape.explode_reviews(pages, keep=("product_id",)), keep=("product_id",))
    return rows.select("product_id", "id", "title", "score", "rating", "status",
                       F.col("created_by.id").alias("author_id"),
                       F.col("created_by.purchased_at").alias("purchased_at"))


def page_requests(spark, base):
    """Review pages 1..last_page (inclusive) per product (last page = p_size)."""
    p = table(spark, base, "part").select(F.col("p_partkey").alias("product_id"), "p_size")
    return reshape.enumerate_pages(p, 1, "p_size").select("product_id", "page")


def listing_ids(spark, base):
    """S3: listing pages {data:[{id}]} -> product ids."""
    part = table(spark, base, "part")
    pages = (part.groupBy(F.floor(F.col("p_partkey") / standins.LISTING_PAGE_SIZE).cast("long").alias("page"))
             .agg(F.collect_list(F.struct(F.col("p_partkey").alias("id"))).alias("data")))
    return reshape.explode_listing(pages, keep=("page",))


def categories_exploded(spark, base):
    """Category payload {items:[{id,name}]} -> (id, name)."""
    nat = table(spark, base, "nation")
    payload = (nat.groupBy(F.floor(F.col("n_nationkey") / 100)).agg(
        F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))).alias("items")))
    return reshape.explode_categories(payload)


def first_n(spark, base):
    """First n products in key order."""
    return scan(table(spark, base, "part"), ["p_partkey", "p_name"], key="p_partkey", limit=FIRST_N)


def range_scan(spark, base):
    """N rows from a start key, in key order."""
    return scan(table(spark, base, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
                key="o_orderkey", start=RANGE_START_KEY, limit=RANGE_LIMIT)


def lookup_by_keys(spark, base):
    """Batch lookup of orders by the keys of returned lines."""
    keys = (table(spark, base, "lineitem").filter(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("o_orderkey")))
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return lookup(o, keys, "o_orderkey")


def messages_parsed(spark, base):
    """K10 + P21: (id, 'name') text messages and their parse (no eval)."""
    ev = table(spark, base, "events")
    msg = ev.select("event_id", misc.to_tuple_message("user_id", "event_type").alias("message"))
    id_, name = misc.parse_tuple_message("message")
    return msg.select("event_id", id_.alias("id"), name.alias("name"))


# ------------------------------------------------------------------ documents

def product_document(spark, base):
    """P4 (+ N9 description, P9/P10 key): product rows -> 22-field documents."""
    return reshape.product_document(standins.product_rows(spark, base))


def rating_document(spark, base):
    """P5: review -> 5-field document."""
    return reshape.rating_document(standins.reviews(_docs(spark, base)))


def _overview(spark, base):
    ov = standins.star_overview(table(spark, base, "lineitem"))
    names = table(spark, base, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name_product"))
    return reshape.overview_document(joins.enrich_name(ov, names))


def overview_document(spark, base):
    """P6 + J1 + D1: star overview per product, flattened (review_photo expanded for comparison)."""
    d = _overview(spark, base)
    return d.select(*[c for c in d.columns if c != "review_photo"],
                    F.col("review_photo.total").alias("review_photo_total"),
                    F.col("review_photo.total_photo").alias("review_photo_total_photo"))


def defaults_applied(spark, base):
    """Missing star counts -> 0, missing percents -> 0.0."""
    d = _overview(spark, base)
    defaults = {"product_id": None}
    for n in range(1, 6):
        defaults[f"stars_{n}_count"] = 0
        defaults[f"stars_{n}_percent"] = 0.0
    return reshape.pick_fields(d, defaults)


def cells_unpivoted(spark, base):
    """Wide rows -> (row_key, column, value) cells."""
    nat = table(spark, base, "nation")
    return reshape.to_cells(nat, "n_nationkey", ["n_name", "n_regionkey"], family="info")


def cells_to_map(spark, base):
    """K14 + P2: star cells ``stars:{n}:count`` -> map of maps, read back as rows."""
    ov = standins.star_overview(table(spark, base, "lineitem"))
    cells = (ov.select(F.col("product_id").alias("row_key"), F.explode("stars").alias("star", "v"))
             .select("row_key", "star", F.col("v.count").cast("string").alias("count")))
    cells = cells.unpivot(["row_key", "star"], ["count"], "attr", "value").select(
        "row_key", F.concat_ws(":", F.lit("stars"), "star", "attr").alias("column"), "value")
    m = reshape.cells_to_map(cells, "stars")
    return (m.select("row_key", F.explode("stars").alias("star", "inner"))
            .select("row_key", "star", F.explode("inner").alias("attr", "value")))


# ------------------------------------------------------------------ filters

def resume_after(spark, base):
    """orders from the first order of the cursor customer onwards."""
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    return filters.resume_after(o, "o_orderkey", "o_custkey", CURSOR_CUSTOMER)


def take_until(spark, base):
    """orders up to and including the first order of the cursor customer."""
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    return filters.take_until(o, "o_orderkey", "o_custkey", CURSOR_CUSTOMER)


def denylist_anti(spark, base):
    """Events of users not on the done list (users with an error on the first day)."""
    ev = table(spark, base, "events").select("event_id", "user_id", "event_type")
    ts = table(spark, base, "events").select("user_id", "event_type", "ts")
    done = (ts.filter((F.col("event_type") == "error") & (F.col("ts") < F.lit(DONE_CUTOFF).cast("timestamp_ntz")))
            .select("user_id").distinct())
    return filters.skip_done(ev, done, "user_id")


def not_yet_sent(spark, base):
    """(id, name) messages not in the history of already-sent messages."""
    m = standins.messages(table(spark, base, "events"))
    cut = F.lit(HISTORY_CUTOFF).cast("timestamp")
    return joins.not_yet_sent(m.filter(F.col("ts") >= cut), m.filter(F.col("ts") < cut))


# ------------------------------------------------------------------ text rules

def clean_base(spark, base):
    """N1 / N2."""
    return _docs(spark, base).select("doc_id", tx.clean_base("text").alias("clean"),
                                     tx.clean_safe("text").alias("clean_safe"))


def _top_line(docs: DataFrame):
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line") != "")
    return (lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("line")).limit(1).select("line"))


def clean_boilerplate(spark, base):
    """The most repeated line (found by Spark) is the boilerplate removed before cleaning."""
    d = _docs(spark, base)
    sentence = _top_line(d).scalar()
    return d.select("doc_id", tx.clean_boilerplate("text", sentence).alias("clean"))


def clean_review_slang(spark, base):
    """N4."""
    return _docs(spark, base).select("doc_id", tx.clean_review_slang("text").alias("clean"))


def clean_collapse(spark, base):
    """N5."""
    return _docs(spark, base).select("doc_id", tx.clean_collapse("text").alias("clean"))


def clean_product(spark, base):
    """N6 on product names and on review text."""
    return _docs(spark, base).select("doc_id", tx.clean_product("text").alias("clean"))


def clean_name(spark, base):
    """Product names."""
    return reshape.product_names(table(spark, base, "part").select(F.col("p_partkey").alias("id"),
                                                                   F.col("p_name").alias("name")))


def clean_name_text(spark, base):
    """N7 on every review text (more varied text than product names)."""
    d = _docs(spark, base)
    return d.select("doc_id", tx.clean_name("text").alias("clean"))


def title_repair(spark, base):
    """Title repaired against its rating label."""
    r = standins.reviews(_docs(spark, base))
    return r.select("id", tx.repair_title("title", F.col("rating").cast("string")).alias("title"))


def html_text(spark, base):
    """HTML pages -> text."""
    pages = spread(table(spark, base, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", tx.html_text("html").alias("text"))


def stopwords_removed(spark, base):
    """N11 + N12: tokens minus the most frequent words (a bounded top-n list, found by Spark)."""
    d = _docs(spark, base).select("doc_id", tx.tokenize(tx.clean_base("text")).alias("tokens"))
    top = aggs.word_freq(d, "tokens").orderBy(F.desc("frequency"), F.asc("word")).limit(STOPWORDS_TOP)
    words = [r["word"] for r in top.collect()]   # bounded: STOPWORDS_TOP rows
    kept = tx.remove_stopwords("tokens", words)
    return d.select("doc_id", F.size(kept).alias("n_kept"), F.array_join(kept, " ").alias("text"))


# ------------------------------------------------------------------ joins

def enrich_left(spark, base):
    """Product ids of the star rows with their names (left outer)."""
    ids = table(spark, base, "lineitem").select(F.col("l_partkey").alias("product_id")).distinct()
    names = table(spark, base, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name_product"))
    return joins.enrich_name(ids, names)


def dictionary_join(spark, base):
    """Text-keyed dictionary (last duplicate wins, missing -> '')."""
    cust = table(spark, base, "customer").select(F.col("c_nationkey").cast("string").alias("k"), "c_name", "c_custkey")
    sup = table(spark, base, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("k"))
    return joins.dictionary_join(sup, cust, "k", "c_name", "c_custkey", "nation_contact").select("s_suppkey", "nation_contact")


# ------------------------------------------------------------------ aggregations

def _reviews_prepared(spark, base):
    from reviewlake.plans import sentiment
    return sentiment.prepare_reviews(standins.reviews(_docs(spark, base)))


def distinct_reviews(spark, base):
    """M15 + A2: labelled, title-repaired, cleaned, distinct reviews."""
    return _reviews_prepared(spark, base)


def char_freq(spark, base):
    """Character frequencies."""
    return aggs.char_freq(_docs(spark, base), "text")


def _tokens(spark, base):
    return _docs(spark, base).select("doc_id", tx.tokenize(tx.clean_base("text")).alias("tokens"))


def word_freq(spark, base):
    """Word frequencies."""
    return aggs.word_freq(_tokens(spark, base), "tokens")


def idf(spark, base):
    """A4: document frequency and IDF per term."""
    t = aggs.idf(_tokens(spark, base), "doc_id", "tokens")
    return t.select("term", "df", F.round("idf", 6).alias("idf"))


def tfidf(spark, base):
    """M1 (term form): tf * idf per (document, term)."""
    w = recommend.tfidf_terms(_tokens(spark, base), "doc_id", "tokens")
    return w.select("doc_id", "term", "tf", F.round("weight", 6).alias("tfidf"))


def filter_counts(spark, base):
    """A5: rows before / after dropping reviews that are empty once cleaned."""
    return aggs.filter_counts(_docs(spark, base), tx.clean_base("text") != "")


def metrics(spark, base):
    """Accuracy / weighted F1 / weighted precision / error of (quality, toxic) pairs."""
    m = aggs.metrics(table(spark, base, "labels"), "quality", "toxic")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


def cluster_count(spark, base):
    """Distinct clusters."""
    return aggs.cluster_count(table(spark, base, "embeddings"), "label")


def upsert_latest(spark, base):
    """The last event per user by (ts, event_id)."""
    ev = table(spark, base, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return aggs.last_per_key(ev, "user_id", ["ts", "event_id"])


# ------------------------------------------------------------------ upserts

def _customer_updates(spark, base) -> tuple[DataFrame, DataFrame]:
    c = table(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    seg = F.col("c_mktsegment")
    changed = c.filter(seg == "BUILDING").select(
        "c_custkey", F.lit(None).cast("string").alias("c_name"), (F.col("c_acctbal") + 100).alias("c_acctbal"),
        "c_mktsegment", F.lit(1).alias("_seq"))
    added = c.filter(seg == "MACHINERY").select(
        (F.col("c_custkey") + 1_000_000).alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment", F.lit(1).alias("_seq"))
    dup1 = c.filter(seg == "AUTOMOBILE").select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"),
                                                F.lit(None).cast("string").alias("c_mktsegment"), F.lit(1).alias("_seq"))
    dup2 = c.filter(seg == "AUTOMOBILE").select("c_custkey", F.lit(None).cast("string").alias("c_name"),
                                                (F.col("c_acctbal") + 2).alias("c_acctbal"),
                                                F.lit("AUTO").alias("c_mktsegment"), F.lit(2).alias("_seq"))
    return c, changed.unionByName(added).unionByName(dup1).unionByName(dup2)


def merge_upsert(spark, base):
    """K2: column-level upsert (new cells overwrite, missing cells survive, new keys inserted)."""
    target, updates = _customer_updates(spark, base)
    return up.merge_upsert(target, updates, "c_custkey", order=["_seq"])


def daily_snapshot(spark, base):
    """K6: one row per (day, product); a second load of the same day updates rows in place."""
    li = table(spark, base, "lineitem")
    rows = li.select(misc.day("l_shipdate").alias("time"), F.col("l_partkey").alias("id"),
                     F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                     "l_orderkey", "l_linenumber", "l_linestatus")
    first = rows.filter(F.col("l_linestatus") == "O").drop("l_linestatus")
    second = rows.filter(F.col("l_linestatus") == "F").drop("l_linestatus")
    snap = up.snapshot_merge(None, first, order=["l_orderkey", "l_linenumber"])
    snap = up.snapshot_merge(snap, second, order=["l_orderkey", "l_linenumber"])
    return snap.select("key", "time", "id", "quantity", "price")


# ------------------------------------------------------------------ vectors and search

def _vectors(spark, base):
    return table(spark, base, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def unit_vectors(spark, base):
    """V1: unit vectors, one row per (id, dimension)."""
    v = _vectors(spark, base).select("id", vx.unit("vec").alias("u"))
    return v.select("id", F.posexplode("u").alias("dim", "value")).select("id", "dim", F.round("value", 6).alias("value"))


def knn_l2(spark, base):
    """K nearest unit vectors by squared L2 for every vector."""
    v = topk.build_vector_table(_vectors(spark, base))
    r = topk.knn(v, v, KNN_K, metric="l2")
    return r.select("qid", "id", "rank", F.round("score", 6).alias("dist"))


def similar_items(spark, base):
    """M9 + F5: nearest neighbours with the query itself dropped."""
    v = topk.build_vector_table(_vectors(spark, base))
    r = topk.knn(v, v, KNN_K, metric="l2")
    r = r.filter(F.col("id") != F.col("qid"))
    return r.select("qid", "id", F.round("score", 6).alias("dist"))


def cosine_topk(spark, base):
    """Top-n by cosine for every vector (the query itself included)."""
    v = _vectors(spark, base)
    r = topk.knn(v, v, COSINE_K, metric="cosine")
    return r.select("qid", "id", "rank", F.round("score", 6).alias("cosine"))


def _product_terms(prod: DataFrame) -> DataFrame:
    meta = prod.select("id", reshape.metadata_text("name", F.col("categories.parent_name")).alias("metadata"))
    return meta.select("id", tx.tokenize("metadata").alias("tokens"))


def similar_tfidf(spark, base):
    """M6 / J5 / T1 re-aimed: for every product, the top-n other products by TF-IDF dot product
    (pruned join of postings, never a cartesian join)."""
    w = recommend.tfidf_terms(_product_terms(standins.product_rows(spark, base)), "id", "tokens")
    r = sparse_topn.top_similar(w, "id", TFIDF_TOP)
    return r.select("id1", "id2", "rank", F.round("score", 6).alias("score"))


def similar_documents(spark, base):
    """M6 / T1 for a table of queries: the top-n other documents by TF-IDF cosine for every document whose
    id is divisible by 50, against all of them."""
    docs = table(spark, base, "documents").select(F.col("doc_id").alias("id"), tx.tokenize("text").alias("tokens"))
    w = recommend.unit_weights(recommend.tfidf_terms(spread(docs, "id"), "id", "tokens", packed=True), "id")
    r = sparse_topn.top_similar(w, "id", TFIDF_TOP, docs.where("id % 50 = 0"))
    return r.select("id1", "id2", "rank", F.round("score", 6).alias("score"))


def recommend_text(spark, base):
    """M7: products similar to the one whose name contains a text (top-n names).

    The product table and its TF-IDF weights (the fitted model) are written once and reused by
    the lookup, the query weights and the scoring scan."""
    prod = cut_lineage(standins.product_rows(spark, base).select("id", "name", "categories"), "products")
    w = cut_lineage(recommend.tfidf_terms(_product_terms(prod), "id", "tokens"), "tfidf-weights")
    r = recommend.recommend_by_text(prod.select("id", "name"), w, "name", RECOMMEND_TEXT, TFIDF_TOP)
    return r.select("id2", "name", "rank", F.round("score", 6).alias("score"))


def product_export(spark, base):
    """Product rows -> 21-field export."""
    return reshape.product_export(standins.product_rows(spark, base))


def product_slim(spark, base):
    """(id, name, category, rating_average, description, seller) with the description cleaned."""
    return reshape.product_slim(standins.product_rows(spark, base))


def category_rollup(spark, base):
    """Roll-up parent category -> category -> brand (products, average price, quantity sold)."""
    p = standins.product_rows(spark, base)
    r = (p.rollup(F.col("categories.parent_name").alias("category_parent_name"),
                  F.col("categories.name").alias("category_name"), F.col("brand.name").alias("brand_name"))
         .agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n_products"),
              F.avg("price").alias("avg_price"), F.sum("all_time_quantity_sold").alias("total_sold")))
    return r.withColumn("avg_price", F.round("avg_price", 6))


def price_changes(spark, base):
    """D3: day-over-day change of price and quantity per product over the daily snapshot."""
    from pyspark.sql import Window
    snap = daily_snapshot(spark, base)
    w = Window.partitionBy("id").orderBy("time")
    return snap.select("id", "time", "price", "quantity",
                       (F.col("price") - F.lag("price").over(w)).alias("price_change"),
                       (F.col("quantity") - F.lag("quantity").over(w)).alias("quantity_change"))


def snapshot_latest(spark, base):
    """K6 + K7: the latest snapshot row per product (one table, a 'current' view on top)."""
    return up.latest_view(daily_snapshot(spark, base)).select("id", "time", "key", "quantity", "price")


def top_rated(spark, base):
    """The n best-rated products (id breaks ties) -> TakeOrderedAndProject."""
    p = standins.product_rows(spark, base).select("id", "name", "rating_average")
    return topk.top_n(p.filter(F.col("rating_average").isNotNull()), "rating_average", TFIDF_TOP)


def description_match(spark, base):
    """Documents whose cleaned words contain a given word."""
    t = _tokens(spark, base)
    return t.filter(F.array_contains("tokens", MATCH_WORD)).select("doc_id")


QUERIES: dict[str, Query] = {
    "label_counts": label_counts,
    "reviews_exploded": reviews_exploded,
    "page_requests": page_requests,
    "listing_ids": listing_ids,
    "categories_exploded": categories_exploded,
    "first_n": first_n,
    "range_scan": range_scan,
    "lookup_by_keys": lookup_by_keys,
    "messages_parsed": messages_parsed,
    "product_document": product_document,
    "rating_document": rating_document,
    "overview_document": overview_document,
    "defaults_applied": defaults_applied,
    "cells_unpivoted": cells_unpivoted,
    "cells_to_map": cells_to_map,
    "resume_after": resume_after,
    "take_until": take_until,
    "denylist_anti": denylist_anti,
    "not_yet_sent": not_yet_sent,
    "clean_base": clean_base,
    "clean_boilerplate": clean_boilerplate,
    "clean_review_slang": clean_review_slang,
    "clean_collapse": clean_collapse,
    "clean_product": clean_product,
    "clean_name": clean_name,
    "clean_name_text": clean_name_text,
    "title_repair": title_repair,
    "html_text": html_text,
    "stopwords_removed": stopwords_removed,
    "enrich_left": enrich_left,
    "dictionary_join": dictionary_join,
    "distinct_reviews": distinct_reviews,
    "char_freq": char_freq,
    "word_freq": word_freq,
    "idf": idf,
    "tfidf": tfidf,
    "filter_counts": filter_counts,
    "metrics": metrics,
    "cluster_count": cluster_count,
    "upsert_latest": upsert_latest,
    "merge_upsert": merge_upsert,
    "daily_snapshot": daily_snapshot,
    "unit_vectors": unit_vectors,
    "knn_l2": knn_l2,
    "similar_items": similar_items,
    "cosine_topk": cosine_topk,
    "similar_tfidf": similar_tfidf,
    "similar_documents": similar_documents,
    "recommend_text": recommend_text,
    "product_export": product_export,
    "product_slim": product_slim,
    "category_rollup": category_rollup,
    "price_changes": price_changes,
    "description_match": description_match,
    "top_rated": top_rated,
    "snapshot_latest": snapshot_latest,
}
