"""Registered queries for operators that the other query modules don't reach, each with its SQL.

All read the given tables whole. Round trips (CSV, JSON, keyed tables) write below the shared folder
and return what is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import codec, misc
from reviewlake.functions import text as tx
from reviewlake.functions import vectors as vx
from reviewlake.operators import filters, reshape, sampling, segment, sinks, topk, upsert
from reviewlake.plans import recommend, sentiment, standins
from reviewlake.session import cut_lineage, scratch_path, spread
from reviewlake.sources import files
from reviewlake.sources.tables import table


def csv_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """K11 + S6 + S8 + P20: part names with quotes and line ends exported to CSV, read back as documents."""
    rows = table(spark, base, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit('a "'), "p_name", F.lit('",\n'), "p_brand").alias("name"),
        F.when(F.col("p_size") % 2 == 0, "TRUE").otherwise("no").alias("is_leaf"), F.col("p_retailprice").alias("price"))
    path = scratch_path(spark, "csv")
    sinks.export_csv(rows, path)
    return files.read_product_csv(spark, path, types={"id": "bigint", "price": "double"})


def csv_inferred(spark: SparkSession, base: str) -> DataFrame:
    """A CSV export read back with inferred types."""
    path = scratch_path(spark, "csv")
    sinks.export_csv(table(spark, base, "nation").select("n_nationkey", "n_name"), path)
    return files.read_csv_inferred(spark, path).select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))


def json_payloads(spark: SparkSession, base: str) -> DataFrame:
    """S1 + K9 + F11: payloads landed as JSON lines among broken ones, read with a schema; a price is required."""
    rows = table(spark, base, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                             F.when(F.col("p_size") % 5 > 0, F.col("p_retailprice")).alias("price"))
    broken = table(spark, base, "nation").select(F.concat(F.lit("{broken "), "n_name").alias("value"))
    path = scratch_path(spark, "json")
    sinks.to_message(rows).unionByName(broken).write.text(path)
    schema = T.StructType.fromDDL("id bigint, name string, price double")
    return filters.require(files.read_products(spark, path, schema), ["price"])


def wordlist(spark: SparkSession, base: str) -> DataFrame:
    """One word per line, stripped, blank lines out, each once."""
    path = scratch_path(spark, "words")
    table(spark, base, "events").select(F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("value")).unionByName(
        table(spark, base, "nation").select(F.lit("  ").alias("value"))).write.text(path)
    return files.read_wordlist(spark, path)


def token_counts(spark: SparkSession, base: str) -> DataFrame:
    """F4 + V7: reviews that have a token other than the empty one, with their first token and number."""
    d = table(spark, base, "documents").select("doc_id", F.filter(tx.tokenize(tx.clean_base("text")), lambda x: x != "").alias("t"))
    return filters.has_tokens(d, "t").select("doc_id", misc.n_tokens("t").alias("n"), misc.first_token("t").alias("first"))


def plain_names(spark: SparkSession, base: str) -> DataFrame:
    """N13 + P22: document text without accents; its language name underscored."""
    return table(spark, base, "documents").select("doc_id", tx.strip_accents(F.lower("text")).alias("plain"),
                                                  tx.underscore(F.concat("lang", F.lit(" "), "source")).alias("place"))


def html_parts(spark: SparkSession, base: str) -> DataFrame:
    """Every paragraph piece of the pages as text (HTML -> text for each array element)."""
    parts = table(spark, base, "pages").select("page_id", tx.html_text_each(F.split("html", "</p>")).alias("parts"))
    return parts.select("page_id", F.posexplode("parts").alias("idx", "text"))


def binary_cells(spark: SparkSession, base: str) -> DataFrame:
    """P1 + P3: numbers as big-endian cells and row keys, decoded again."""
    rows = table(spark, base, "customer").select(
        codec.encode_int(F.col("c_custkey")).alias("row_key"), codec.encode_int(F.col("c_nationkey") - 12).alias("nation"),
        F.encode("c_name", "UTF-8").alias("name"))
    return codec.decode_cells(rows, {"nation": "int", "name": "string"}).select(
        reshape.decode_key("row_key", F.lit(True)).alias("id"), F.col("nation"), F.col("name"))


def stamped_defaults(spark: SparkSession, base: str) -> DataFrame:
    """P9 + P12 + P14: a given snapshot date; a missing brand becomes the empty one; nested fields."""
    rows = table(spark, base, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 > 0, F.struct(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"))).alias("brand"))
    full = reshape.default_struct(reshape.stamp_date(rows, "2024-05-06"), "brand", {"id": 0, "name": ""})
    return full.select("id", "time", F.col("brand.id").alias("brand_id"), F.col("brand.name").alias("brand_name"))


def reviews_normalized(spark: SparkSession, base: str) -> DataFrame:
    """P15 + P16: payload text with the author present, absent, null, without id, or with a null id (dropped)."""
    kind = F.col("doc_id") % 5
    author = (F.when(kind == 0, F.concat(F.lit(', "created_by": {"id": '), "doc_id", F.lit(', "name": "n"}')))
              .when(kind == 1, F.lit(', "created_by": null')).when(kind == 2, F.lit(', "created_by": {"name": "x"}'))
              .when(kind == 3, F.lit(', "created_by": {"id": null}')).otherwise(F.lit("")))
    lines = table(spark, base, "documents").select(F.concat(
        F.lit('{"id": '), "doc_id", F.lit(', "rating": '), (F.col("doc_id") % 6).cast("string"), author, F.lit("}")).alias("value"))
    from reviewlake import schemas
    kept = reshape.drop_null_author(lines.withColumn("v", F.parse_json("value")))
    typed = kept.select(F.from_json("value", schemas.REVIEW).alias("r")).select("r.*")
    return reshape.normalize_review(typed).select("id", "score", F.col("created_by.id").alias("author_id"),
                                                  F.col("created_by.name").alias("author_name"), F.size("images").alias("n_images"))


def reviews_payload(spark: SparkSession, base: str) -> DataFrame:
    """P15 whole, on raw payloads: fields present, absent or null, and authors with or without a summary."""
    kind = F.col("doc_id") % 4
    text = lambda name, v: (F.when(kind == 0, F.concat(F.lit(f', "{name}": "'), v, F.lit('"'))).when(kind == 1, F.lit(f', "{name}": null'))
                            .otherwise(F.lit("")))
    author = F.concat(F.lit('"id": '), F.col("doc_id").cast("string"), text("name", F.col("lang")), text("region", F.col("source")),
                      F.when(kind == 0, F.lit(', "purchased": true, "purchased_at": 7')).when(kind == 1, F.lit(', "purchased_at": null')).otherwise(""),
                      F.when(kind < 2, F.concat(F.lit(', "contribute_info": {"summary": {"total_review": '), F.col("n_chars").cast("string"),
                                                F.lit("}}"))).otherwise(""))
    lines = table(spark, base, "documents").select(F.parse_json(F.concat(
        F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit(', "rating": "'), (F.col("doc_id") % 6).cast("string"), F.lit('"'),
        text("title", F.col("lang")), F.when(kind == 3, F.lit("")).otherwise(F.concat(F.lit(', "created_by": {'), author, F.lit("}"))),
        F.when(kind == 2, F.lit(', "images": [{"id": 1, "full_path": "a"}]')).otherwise(""), F.lit("}"))).alias("v"))
    found = reshape.normalize_review_payload(lines)
    by = [F.col(f"created_by.{n}").alias(f"author_{n}") for n in ("id", "name", "region", "full_name", "joined_time", "purchased", "purchased_at",
                                                                 "total_review", "total_thank")]
    return found.select("id", "title", "content", "thank_count", "rating", "score", F.size("images").alias("n_images"), *by)


def parent_stamped(spark: SparkSession, base: str) -> DataFrame:
    """The category that drove a listing stamped as parent into every product of it."""
    nations = table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, base, "region").select("r_regionkey", "r_name")
    rows = (table(spark, base, "supplier").select("s_suppkey", "s_nationkey").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(regions, F.col("n_regionkey") == F.col("r_regionkey")))
    rows = rows.withColumn("categories", F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                                                  F.lit(None).cast("long").alias("parent_id"), F.lit(None).cast("string").alias("parent_name")))
    return reshape.stamp_parent(rows, F.col("r_regionkey").cast("long"), "r_name").select(F.col("s_suppkey").alias("product_id"), "categories.*")


def image_rows(spark: SparkSession, base: str) -> DataFrame:
    """Up to three images of every document as indexed rows."""
    image = lambda i: F.struct((F.col("doc_id") * 10 + i).alias("id"), F.concat_ws("/", "source", i.cast("string")).alias("full_path"))
    rows = table(spark, base, "documents").where("doc_id % 4 > 0").select(
        "doc_id", F.transform(F.sequence(F.lit(1).cast("long"), F.col("doc_id") % 4), image).alias("images"))
    return reshape.explode_images(rows, key="doc_id").select("doc_id", F.col("idx"), F.col("id").alias("image_id"), "full_path")


def map_columns(spark: SparkSession, base: str) -> DataFrame:
    """V8: how often each user did what, from a map to columns."""
    counts = table(spark, base, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))     # a row per kind of event
    return reshape.map_to_columns(maps, "m", ["click", "view", "error"], "n_").drop("m")


def table_if_absent(spark: SparkSession, base: str) -> DataFrame:
    """K1: a table is created where there is none and left alone where there is one."""
    rows, path = table(spark, base, "nation").select("n_nationkey", "n_name"), scratch_path(spark, "created")
    upsert.ensure_table(spark, path, rows.schema)
    rows.write.mode("append").parquet(path)
    upsert.ensure_table(spark, path, rows.schema)
    return spark.read.parquet(path)


def hashed_totals(spark: SparkSession, base: str) -> DataFrame:
    """M1, hashed form: the counts of a document's features add up to its tokens, whatever terms share a feature."""
    from pyspark.ml.functions import vector_to_array
    d = table(spark, base, "documents").select("doc_id", tx.tokenize(tx.clean_base("text")).alias("tokens"))
    raw = vector_to_array("raw_features")
    found = recommend.tfidf_vectors(d, "tokens", num_features=1 << 12)
    return found.select("doc_id", F.aggregate(raw, F.lit(0.0), lambda a, x: a + x).cast("long").alias("n_tokens"))


def name_components(spark: SparkSession, base: str) -> DataFrame:
    """M2: products, terms of their names, and sums of five principal components that are not 0 (components are centred)."""
    names = cut_lineage(standins.product_rows(spark, base).select("id", tx.tokenize(tx.clean_name("name")).alias("tokens")), "name-tokens")
    found = recommend.tfidf_components(names, "id", "tokens", ["small"], k=5)
    sums = F.array(*[F.sum(F.col("pca_features")[i]) for i in range(5)])
    n_terms = names.select(F.explode(tx.remove_stopwords("tokens", ["small"])).alias("t")).agg(F.countDistinct("t").alias("n_terms"))
    return found.agg(F.count(F.lit(1)).alias("n"), F.size(F.filter(sums, lambda x: F.abs(x) > 1e-6)).alias("n_uncentred")).join(n_terms)


def cluster_violations(spark: SparkSession, base: str) -> DataFrame:
    """M5: vectors, clusters used, and vectors that lie nearer to another cluster's centre than to their own (none)."""
    from pyspark.ml.functions import array_to_vector
    v = cut_lineage(table(spark, base, "embeddings").select(F.col("vec_id").alias("id"), vx.as_double("embedding").alias("vec"),
                                                            array_to_vector("embedding").alias("features")), "cluster-vectors")
    model = recommend.fit_clusters(v, "features", 3)
    centres = [F.array(*[F.lit(float(x)) for x in c]) for c in model.stages[-1].clusterCenters()]      # three
    distances = F.array(*[vx.sq_l2("vec", c) for c in centres])
    own = F.element_at(distances, F.col("prediction") + 1)
    return model.transform(v).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("prediction").alias("n_clusters"),
                                  F.count_if(own > F.array_min(distances) + 1e-9).alias("n_violations"))


def word2vec_coverage(spark: SparkSession, base: str) -> DataFrame:
    """M4: a product has a vector other than zero exactly if one of its words occurs five times or more."""
    from pyspark.ml.functions import vector_to_array
    names = standins.product_rows(spark, base).select("id", tx.clean_name("name").alias("name"))
    toks = cut_lineage(filters.has_tokens(names.withColumn("tokens", tx.tokenize("name")), "tokens"), "name-tokens")
    model = recommend.fit_word2vec(toks, "tokens", "features", size=16)
    return model.transform(toks).select("id", F.exists(vector_to_array("features"), lambda x: x != 0).alias("has_vector"))


def images_and_specs(spark: SparkSession, base: str) -> DataFrame:
    """P17 + P18: attribute lists of products as one row per (spec, attribute), the last of repeated ones."""
    attribute = lambda c, v: F.struct(F.lit(c).alias("code"), v.cast("string").alias("value"))
    rows = table(spark, base, "part").select(F.col("p_partkey").alias("id"), F.array(F.struct(
        F.lit("main").alias("name"), F.array(attribute("brand", F.col("p_brand")), attribute("size", F.col("p_size")),
                                             attribute("brand", F.col("p_type"))).alias("attributes"))).alias("specifications"))
    return reshape.explode_specs(rows).select("id", F.explode("specs").alias("spec", "value"))


def pair_of_one(spark: SparkSession, base: str) -> DataFrame:
    """F6 + V2: dot products of the vector with the smallest id and every other one."""
    v = table(spark, base, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    one = v.where(F.col("vec_id") == 0).select(F.col("vec_id").alias("id1"), F.col("v").alias("v1"))
    pairs = v.select(F.lit(0).cast("long").alias("id1"), F.col("vec_id").alias("id2"), "v").join(F.broadcast(one), "id1")
    return filters.pairs_of(pairs, 0).select("id2", F.round(vx.dot("v1", "v"), 6).alias("dot"))


def backfill_bounds(spark: SparkSession, base: str) -> DataFrame:
    """Numbers written into rows drawn by seed; all rows stay and every number is within its bounds."""
    rows = table(spark, base, "part").select("p_partkey", F.lit(-1).alias("x"))
    out = sampling.random_backfill(rows, "p_partkey", "x", 3, 9, draws=500)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if((F.col("x") != -1) & ~F.col("x").between(3, 9)).alias("n_outside"))


def random_backfill(spark: SparkSession, base: str) -> DataFrame:
    """9,737 seeded draws of a part, each with a number from 1 to 19,584; the last number of a part stays."""
    rows = table(spark, base, "part").select("p_partkey", F.lit(-1).alias("favourite_count"))
    return sampling.random_backfill(rows, "p_partkey", "favourite_count", 1, 19_584, draws=9_737)


def recommend_texts(spark: SparkSession, base: str) -> DataFrame:
    """F7 + M7 for a table of texts (pieces of the names of parts whose key is divisible by 50): the product that a text finds
    and the ten most similar others."""
    prod = cut_lineage(standins.product_rows(spark, base).select("id", "name", "categories"), "products")
    meta = prod.select("id", reshape.metadata_text("name", F.col("categories.parent_name")).alias("metadata"))
    w = recommend.tfidf_terms(meta.select("id", tx.tokenize("metadata").alias("tokens")), "id", "tokens")
    texts = table(spark, base, "part").where("p_partkey % 50 = 0").select(
        F.col("p_partkey").alias("qid"), F.expr("substring(p_name, 3, int(p_partkey % 7))").alias("text"))
    found = recommend.recommend_by_texts(prod.select("id", "name"), w, texts, "name", 10)
    return found.select("qid", "id1", "id2", "name", "rank", F.round("score", 6).alias("score"))


def compounds(spark: SparkSession, base: str) -> DataFrame:
    """N11, learning: pairs of words that stand together far more often than by chance."""
    docs = table(spark, base, "documents").select(tx.tokenize(tx.clean_base("text")).alias("tokens"))
    return segment.learn(spread(docs), "tokens", max_length=2).select("compound", "n", "gain")


def segmented(spark: SparkSession, base: str) -> DataFrame:
    """Words of every document, with learned compounds joined by the best path."""
    docs = cut_lineage(spread(table(spark, base, "documents").select("doc_id", tx.tokenize(tx.clean_base("text")).alias("tokens"))), "tokens")
    found = segment.segment(docs, "tokens", segment.learn(docs, "tokens", max_length=2), max_length=2)
    joined = F.filter("words", lambda w: F.contains(w, F.lit("_")))
    return found.select("doc_id", F.size("words").alias("n_words"), F.array_join(joined, " ").alias("joined"))


def knn_queries(spark: SparkSession, base: str) -> DataFrame:
    """The 20 nearest vectors of every query (ids divisible by 50); the vectors are not shuffled."""
    v = topk.build_vector_table(table(spark, base, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec")))
    q = v.where("id % 50 = 0").select(F.col("id").alias("qid"), "vec")
    return topk.knn_batch(v, q, 20).select("qid", "id", F.round("score", 6).alias("score"), "rank")


def similar_names(spark: SparkSession, base: str) -> DataFrame:
    """Nearest labelled vectors of every query, without hits that have the query's own name."""
    e = table(spark, base, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("name"),
                                                F.col("embedding").alias("vec"))
    v = topk.build_vector_table(e.select("id", "vec"))
    q = v.where("id % 50 = 0").select(F.col("id").alias("qid"), "vec")
    names = e.select("id", "name")
    hits = topk.knn_batch(v, q, 20).join(names, "id").join(
        names.select(F.col("id").alias("qid"), F.col("name").alias("query_name")), "qid")
    return filters.exclude_name(hits, "name", "query_name").select("qid", "id", "name", "rank")


def keyed_table_merge(spark: SparkSession, base: str) -> DataFrame:
    """K1-K3: three batches of partial product rows, with repeated keys, through a keyed table."""
    t = upsert.product_table(spark, scratch_path(spark, "keyed"), 16)
    p = table(spark, base, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_retailprice", "p_size")
    price = F.col("p_retailprice")
    null = F.lit(None)
    first = p.select("id", F.col("p_name").alias("name"), price.alias("price"), F.lit(0).alias("at"))
    second = p.where("p_size % 2 = 0").select("id", null.cast("string").alias("name"), (price * 2).alias("price"), F.lit(0).alias("at"))
    third = p.where("p_size % 3 = 0").select("id", F.lit("old").alias("name"), null.cast("double").alias("price"), F.lit(0).alias("at")) \
        .unionByName(p.where("p_size % 3 = 0").select("id", F.lit("new").alias("name"), null.cast("double").alias("price"), F.lit(1).alias("at")))
    for i, batch in enumerate((first, second, third, second.where("false"))):
        t.upsert(batch, arrival=["at"], batch_id=i, query="load")
    t.upsert(first, arrival=["at"], batch_id=1, query="load")                 # a replay
    return t.read().select("id", "name", "price")


def snapshot_written(spark: SparkSession, base: str) -> DataFrame:
    """K6 + P10: daily snapshots of the events' users, written twice; the second run fills in late rows."""
    path = scratch_path(spark, "snapshot")
    rows = table(spark, base, "events").select(misc.day(F.col("ts")).alias("time"), F.col("user_id").alias("id"),
                                               F.col("event_id").alias("qty"), F.col("event_id").alias("seq"))
    upsert.write_daily_snapshot(spark, path, rows.where("seq % 2 = 0"), ["seq"], batch_id=0)
    upsert.write_daily_snapshot(spark, path, rows.where("seq % 2 = 1"), ["seq"], batch_id=1)
    return upsert.KeyedTable(spark, path, ["time", "id"], partition_col="time").read().select("key", "time", "id", "qty")


def reviews_simple(spark: SparkSession, base: str) -> DataFrame:
    """M15, simple form."""
    return sentiment.simple_reviews(standins.reviews(table(spark, base, "documents")))


def reviews_table(spark: SparkSession, base: str) -> DataFrame:
    """M15, table form, without rows that are empty after cleaning."""
    return sentiment.table_reviews(standins.reviews(table(spark, base, "documents")), drop_empty=True)


COVERAGE_QUERIES = {q.__name__: q for q in (
    csv_round_trip, csv_inferred, json_payloads, wordlist, token_counts, plain_names, html_parts, binary_cells, stamped_defaults,
    reviews_normalized, images_and_specs, pair_of_one, backfill_bounds, random_backfill, recommend_texts, compounds, segmented,
    reviews_payload, parent_stamped, name_components, image_rows, map_columns, table_if_absent, hashed_totals, cluster_violations, word2vec_coverage, knn_queries, similar_names, keyed_table_merge,
    snapshot_written, reviews_simple, reviews_table)}


def sentiment_label_sql(rating: str) -> str:
    return (f"CASE {rating} WHEN 1 THEN 'negative' WHEN 2 THEN 'negative' WHEN 3 THEN 'neutral' WHEN 4 THEN 'positive' "
            f"WHEN 5 THEN 'positive' ELSE 'Unknown' END")


def coverage_oracles() -> dict[str, str]:
    from reviewlake.plans.oracles import PRODUCT_TERMS, PRODUCTS, clean_base, clean_name, decode_entities
    _COMPOUNDS = f"""WITH RECURSIVE t AS (SELECT doc_id, [x FOR x IN string_split({clean_base('text')}, ' ') IF x <> ''] AS t FROM documents),
u AS (SELECT x, count(*) AS n FROM (SELECT unnest(t) AS x FROM t) GROUP BY x),
z AS (SELECT CAST(sum(n) AS DOUBLE) AS z FROM u),
b AS (SELECT doc_id, i, t[i] AS a, t[i + 1] AS b FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM t)),
p AS (SELECT a, b, count(*) AS n FROM b GROUP BY a, b HAVING count(*) >= {segment.MIN_COUNT}),
g AS (SELECT a || '_' || b AS compound, p.n, CAST(round((ln(p.n / z) - (ln(x.n / z) + ln(y.n / z))) * 1000000) AS BIGINT) AS gain
      FROM p JOIN u x ON x.x = a JOIN u y ON y.x = b, z
      WHERE CAST(round((ln(p.n / z) - (ln(x.n / z) + ln(y.n / z))) * 1000000) AS BIGINT) >= {segment.MIN_GAIN})"""
    unit = """u AS (SELECT vec_id, embedding, sqrt(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) FOR x IN embedding])) AS n FROM embeddings),
v AS (SELECT vec_id AS id, CASE WHEN n > 0 THEN [CAST(x AS DOUBLE) / n FOR x IN embedding] ELSE [0.0 FOR x IN embedding] END AS v FROM u),
s AS (SELECT q.id AS qid, c.id, list_sum([(a[1] - a[2]) * (a[1] - a[2]) FOR a IN list_zip(q.v, c.v)]) AS score
      FROM v q JOIN v c ON q.id % 50 = 0),
r AS (SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(score, 9), id) AS INTEGER) AS rank FROM s)"""
    tags = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '(?s)<!--.*?-->', '', 'g'), " \
           "'(?is)<script[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style[^>]*>.*?</style\\s*>', '', 'g'), '(?s)<[^>]*>', '', 'g')"
    return {
        "csv_round_trip": """SELECT p_partkey AS id, 'a "' || p_name || '",' || chr(10) || p_brand AS name, p_size % 2 = 0 AS is_leaf,
p_retailprice AS price FROM part""",
        "csv_inferred": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
        "json_payloads": "SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part WHERE p_size % 5 > 0 AND p_retailprice IS NOT NULL",
        "wordlist": "SELECT DISTINCT trim(event_type) AS word FROM events",
        "token_counts": f"""WITH t AS (SELECT doc_id, [x FOR x IN string_split({clean_base('text')}, ' ') IF x <> ''] AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n, t[1] AS first FROM t WHERE len(t) > 0""",
        "plain_names": """SELECT doc_id, strip_accents(lower(text)) AS plain, replace(lang || ' ' || source, ' ', '_') AS place FROM documents""",
        "html_parts": f"""WITH p AS (SELECT page_id, string_split(html, '</p>') AS parts FROM pages),
e AS (SELECT page_id, unnest(range(len(parts))) AS idx, unnest(parts) AS x FROM p),
c AS (SELECT page_id, idx, {tags} AS x FROM e)
SELECT page_id, CAST(idx AS INTEGER) AS idx, replace({decode_entities('x')}, '\\n', '') AS text FROM c""",
        "binary_cells": "SELECT CAST(c_custkey AS INTEGER) AS id, CAST(c_nationkey - 12 AS INTEGER) AS nation, c_name AS name FROM customer",
        "stamped_defaults": """SELECT p_partkey AS id, '2024-05-06' AS time, CASE WHEN p_size % 3 > 0 THEN p_partkey ELSE 0 END AS brand_id,
CASE WHEN p_size % 3 > 0 THEN p_brand ELSE '' END AS brand_name FROM part""",
        "reviews_normalized": """SELECT doc_id AS id, CAST(doc_id % 6 AS DOUBLE) AS score, CASE WHEN doc_id % 5 = 0 THEN doc_id ELSE 0 END AS author_id,
CASE doc_id % 5 WHEN 0 THEN 'n' WHEN 2 THEN 'x' ELSE '' END AS author_name, 0 AS n_images FROM documents WHERE doc_id % 5 <> 3""",
        "reviews_payload": """WITH k AS (SELECT *, doc_id % 4 AS k FROM documents)
SELECT doc_id AS id, CASE k WHEN 0 THEN lang WHEN 1 THEN NULL ELSE '' END AS title, '' AS content, CAST(0 AS BIGINT) AS thank_count,
CAST(doc_id % 6 AS DOUBLE) AS rating, CAST(doc_id % 6 AS DOUBLE) AS score, CAST(CASE WHEN k = 2 THEN 1 ELSE 0 END AS INTEGER) AS n_images,
CASE WHEN k = 3 THEN 0 ELSE doc_id END AS author_id, CASE k WHEN 0 THEN lang WHEN 1 THEN NULL ELSE '' END AS author_name,
CASE k WHEN 0 THEN source WHEN 1 THEN NULL ELSE '' END AS author_region, '' AS author_full_name, '' AS author_joined_time,
CASE k WHEN 0 THEN 'true' ELSE '' END AS author_purchased, CAST(CASE k WHEN 0 THEN 7 ELSE 0 END AS BIGINT) AS author_purchased_at,
CAST(CASE WHEN k < 2 THEN n_chars ELSE 0 END AS BIGINT) AS author_total_review, CAST(0 AS BIGINT) AS author_total_thank FROM k""",
        "parent_stamped": """SELECT s_suppkey AS product_id, CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(r_regionkey AS BIGINT) AS parent_id,
r_name AS parent_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
        "image_rows": """SELECT doc_id, CAST(i - 1 AS INTEGER) AS idx, doc_id * 10 + i AS image_id, source || '/' || i AS full_path
FROM (SELECT doc_id, source, unnest(range(1, doc_id % 4 + 1)) AS i FROM documents)""",
        "map_columns": """SELECT user_id, """ + ", ".join(
            f"nullif(count(*) FILTER (event_type = '{k}'), 0) AS n_{k}" for k in ("click", "view", "error")) + " FROM events GROUP BY user_id",
        "table_if_absent": "SELECT n_nationkey, n_name FROM nation",
        "hashed_totals": f"SELECT doc_id, CAST(len(string_split({clean_base('text')}, ' ')) AS BIGINT) AS n_tokens FROM documents",
        "name_components": f"""WITH {PRODUCTS.strip()},
t AS (SELECT DISTINCT unnest(string_split({clean_name('name')}, ' ')) AS t FROM products)
SELECT (SELECT count(*) FROM products) AS n, CAST(0 AS INTEGER) AS n_uncentred, count(*) AS n_terms FROM t WHERE t <> 'small'""",
        "cluster_violations": "SELECT count(*) AS n, CAST(least(3, count(*)) AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_violations FROM embeddings",
        "word2vec_coverage": f"""WITH {PRODUCTS.strip()},
t AS (SELECT id, unnest(string_split({clean_name('name')}, ' ')) AS w FROM products),
n AS (SELECT w, count(*) AS n FROM t GROUP BY w)
SELECT id, bool_or(n >= 5) AS has_vector FROM t JOIN n USING (w) GROUP BY id""",
        "images_and_specs": """SELECT p_partkey AS id, 'main:brand' AS spec, p_type AS value FROM part
UNION ALL SELECT p_partkey, 'main:size', CAST(p_size AS VARCHAR) FROM part""",
        "pair_of_one": """SELECT b.vec_id AS id2, round(list_sum([CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE) FOR x IN list_zip(a.embedding, b.embedding)]), 6) AS dot
FROM embeddings a JOIN embeddings b ON a.vec_id = 0 AND b.vec_id <> 0""",
        "backfill_bounds": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM part",
        "random_backfill": """WITH d AS (SELECT i, CAST('0x' || sha256('42:' || i)[1:15] AS BIGINT) % (SELECT count(*) FROM part) AS position,
  1 + CAST('0x' || sha256('43:' || i)[1:15] AS BIGINT) % 19584 AS number FROM range(9737) t(i)),
l AS (SELECT position, arg_max(number, i) AS number FROM d GROUP BY position),
p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS position FROM part)
SELECT p_partkey, CAST(coalesce(number, -1) AS INTEGER) AS favourite_count FROM p LEFT JOIN l USING (position)""",
        "recommend_texts": f"""{PRODUCT_TERMS.strip()},
t AS (SELECT p_partkey AS qid, substr(p_name, 3, p_partkey % 7) AS text FROM part WHERE p_partkey % 50 = 0),
q AS (SELECT t.qid, min(p.id) AS id1 FROM t JOIN products p ON contains(p.name, t.text) GROUP BY t.qid),
s AS (SELECT q.qid, q.id1, b.id AS id2, sum(a.weight * b.weight) AS score
      FROM q JOIN w a ON a.id = q.id1 JOIN w b ON b.term = a.term AND b.id <> q.id1 GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id2) AS rank FROM s)
SELECT qid, id1, id2, p.name, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r JOIN products p ON p.id = id2 WHERE rank <= 10""",
        "compounds": f"""{_COMPOUNDS} SELECT compound, n, gain FROM g""",
        "segmented": f"""{_COMPOUNDS},
m AS (SELECT t.doc_id, t.i, t.a || '_' || t.b AS compound, g.gain, t.i - row_number() OVER (PARTITION BY t.doc_id ORDER BY t.i) AS run
      FROM b t JOIN g ON g.compound = t.a || '_' || t.b),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS j, count(*) OVER (PARTITION BY doc_id, run) AS len FROM m),
f AS (SELECT doc_id, run, j, len, i, compound, gain AS best, CAST(0 AS BIGINT) AS before, true AS take FROM k WHERE j = 1
      UNION ALL SELECT k.doc_id, k.run, k.j, k.len, k.i, k.compound, greatest(f.before + k.gain, f.best), f.best, f.before + k.gain >= f.best
      FROM f JOIN k ON k.doc_id = f.doc_id AND k.run = f.run AND k.j = f.j + 1),
c AS (SELECT doc_id, run, j, i, compound, take FROM f WHERE j = len
      UNION ALL SELECT f.doc_id, f.run, f.j, f.i, f.compound, f.take FROM c JOIN f
      ON f.doc_id = c.doc_id AND f.run = c.run AND f.j = c.j - CASE WHEN c.take THEN 2 ELSE 1 END),
o AS (SELECT doc_id, count(*) AS n, string_agg(compound, ' ' ORDER BY i) AS joined FROM c WHERE take GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.t) - coalesce(o.n, 0) AS INTEGER) AS n_words, coalesce(joined, '') AS joined FROM t LEFT JOIN o USING (doc_id)""",
        "knn_queries": f"WITH {unit} SELECT qid, id, round(score, 6) AS score, rank FROM r WHERE rank <= 20",
        "two_level_search": f"WITH {unit} SELECT qid, id, round(score, 6) AS score, rank FROM r WHERE rank <= 20",
        "similar_names": f"""WITH {unit} SELECT r.qid, r.id, CAST(e.label AS VARCHAR) AS name, r.rank FROM r JOIN embeddings e ON e.vec_id = r.id
JOIN embeddings q ON q.vec_id = r.qid WHERE rank <= 20 AND e.label IS DISTINCT FROM q.label""",
        "keyed_table_merge": """SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'new' ELSE p_name END AS name,
CASE WHEN p_size % 2 = 0 THEN p_retailprice * 2 ELSE p_retailprice END AS price FROM part""",
        "snapshot_written": """WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS time, user_id AS id, event_id FROM events)
SELECT time || '_' || id AS key, time, id, event_id AS qty FROM r
QUALIFY row_number() OVER (PARTITION BY time, id ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
        "reviews_simple": f"""SELECT DISTINCT string_split(text, chr(10))[1] || ' ' || text AS content, {sentiment_label_sql('doc_id % 6')} AS label FROM documents""",
        "reviews_table": f"""SELECT {clean_base('text')} AS content, {sentiment_label_sql('doc_id % 6')} AS label FROM documents
WHERE text IS NOT NULL AND {clean_base('text')} <> ''""",
    }
