"""Recommenders (A4, M1-M3, M6-M11): TF-IDF similarity, Word2Vec + clusters, exact vector search.

TF-IDF is kept in term form ``(id, term, tf, weight)`` so it is SQL-checkable and free of hashing
collisions; ``tfidf_vectors`` gives the MLlib ``HashingTF + IDF`` vectors as well.
"""

from __future__ import annotations


from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, StandardScaler, StopWordsRemover, VectorAssembler, Word2Vec
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions import text as tx
from reviewlake.operators import filters, sparse_pca, sparse_topn, term_blocks, two_level
from reviewlake.operators.joins import attach_names, broadcast_if_small
from reviewlake.operators.term_blocks import TermBlocks
from reviewlake.operators.topk import RANK_DIGITS
from reviewlake.session import cut_lineage

def term_counts(tokens: Column) -> Column:
    """Array of (term, tf) of one row's tokens: runs of the sorted array, so no shuffle is needed to count."""
    def runs(t: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: (i == 1) | (
            F.element_at(t, i.cast("int")) != F.element_at(t, F.greatest(i - 1, F.lit(1)).cast("int"))))
        return F.transform(F.array(first), lambda at: F.zip_with(
            at, F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(t) + 1)),
            lambda i, j: F.struct(F.element_at(t, i.cast("int")).alias("term"), (j - i).cast("long").alias("tf")))).getItem(0)
    # Bound once per row through a one-element transform, so that no lambda sorts the array again.
    counted = F.transform(F.array(F.array_sort(tokens)), runs).getItem(0)
    return F.when(F.size(tokens) > 0, counted)


#: Rows from which ``tfidf_terms`` may keep postings in blocks.
PACKED_ROWS = 20_000


def tfidf_terms(df: DataFrame, id_col: str, tokens_col: str, packed: bool = False) -> DataFrame | TermBlocks:
    """M1 (term form): (id, term, tf, weight = tf * ln((N+1)/(df+1))); one row of ``df`` per id.

    Terms are counted inside their row; document frequency is one aggregate by term (combined in each
    task), joined back by term, where AQE broadcasts a small side or splits a frequent term.

    With ``packed``, many rows of distinct ids become ``TermBlocks``, for ``unit_weights`` and ``top_similar``."""
    if packed and (n_rows := df.count()) > PACKED_ROWS and df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
            F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return term_blocks.build(df, id_col, tokens_col, n_rows)
    tf = df.select(id_col, F.inline(term_counts(F.filter(tokens_col, lambda x: x.isNotNull()))))
    n_docs = df.select(F.count(F.lit(1))).scalar()
    idf = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
           .select("term", F.ln((n_docs + F.lit(1)) / (F.col("df") + F.lit(1))).alias("idf")))
    return tf.join(idf, "term").select(id_col, "term", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def unit_weights(weights: DataFrame | TermBlocks, id_col: str) -> DataFrame | TermBlocks:
    """Term weights divided by the length of their row's vector, so that dot products are cosines; rows of
    length 0 keep weights of 0."""
    if isinstance(weights, TermBlocks):
        return weights.unit_weights()
    length = weights.groupBy(id_col).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    return weights.join(length, id_col).select(
        id_col, "term", F.when(F.col("length") > 0, F.col("weight") / F.col("length")).otherwise(F.lit(0.0)).alias("weight"))


def tfidf_vectors(df: DataFrame, tokens_col: str, num_features: int = 1 << 18) -> DataFrame:
    """M1 (MLlib form): HashingTF(2^18) + IDF pipeline -> ``features``."""
    pipe = Pipeline(stages=[HashingTF(inputCol=tokens_col, outputCol="raw_features", numFeatures=num_features),
                            IDF(inputCol="raw_features", outputCol="features")])
    return pipe.fit(df).transform(df)


def tfidf_counts(df: DataFrame, tokens_col: str, stopwords: list[str], k: int = 100, n_features: int = 1 << 10) -> DataFrame:
    """M2: stop words removed, term counts + IDF + PCA(k).

    MLlib's PCA builds a features x features covariance on the driver, so here the terms are hashed to a fixed
    number of features. ``tfidf_components`` has no such limit."""
    pipe = Pipeline(stages=[StopWordsRemover(inputCol=tokens_col, outputCol="filtered", stopWords=stopwords),
                            HashingTF(inputCol="filtered", outputCol="raw_features", numFeatures=n_features),
                            IDF(inputCol="raw_features", outputCol="features"),
                            PCA(k=k, inputCol="features", outputCol="pca_features")])
    return pipe.fit(df).transform(df)


def tfidf_components(df: DataFrame, id_col: str, tokens_col: str, stopwords: list[str], k: int = 100) -> DataFrame:
    """M2 for any number of terms: (id, pca_features), the ``k`` principal components of the TF-IDF weights without stop words.
    No term is hashed together with another (see ``sparse_pca``)."""
    rows = df.select(id_col, tx.remove_stopwords(tokens_col, stopwords).alias("tokens"))
    found, _variances = sparse_pca.components(rows, tfidf_terms(rows, id_col, "tokens"), k, id_col)
    return found


def assemble(df: DataFrame, cols: list[str], out: str = "features_vec") -> DataFrame:
    """M3: VectorAssembler."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def recommend_by_text(products: DataFrame, w: DataFrame, name_col: str, text: str, top: int = 10,
                      id_col: str = "id") -> DataFrame:
    """M7: find the product whose name contains ``text`` (smallest id), then the ``top`` other
    products by TF-IDF dot product, with their names.

    One scan of the weights: the query's own terms (one product, size-checked) are broadcast.
    """
    q = filters.find_product(products, name_col, text, id_col)
    qw = w.join(q, id_col, "left_semi").select("term", F.col("weight").alias("qweight"), F.col(id_col).alias("_qid"))
    scores = (w.join(broadcast_if_small(qw, 100_000), "term")
              .filter(F.col(id_col) != F.col("_qid"))
              .groupBy(F.col(id_col).alias("id2")).agg(F.sum(F.col("weight") * F.col("qweight")).alias("score")))
    wnd = Window.orderBy(F.round("score", RANK_DIGITS).desc(), F.col("id2").asc())
    best = scores.orderBy(F.round("score", RANK_DIGITS).desc(), F.col("id2").asc()).limit(top)
    best = best.withColumn("rank", F.row_number().over(wnd))
    return attach_names(best, products, sim_key="id2", key=id_col, cols=(name_col,)).select(
        "id2", name_col, "rank", "score")


def recommend_by_texts(products: DataFrame, w: DataFrame, queries: DataFrame, name_col: str, top: int = 10,
                       id_col: str = "id") -> DataFrame:
    """M7 for a table of queries (qid, text): the product that each text finds, then the ``top`` other products by
    TF-IDF dot product, with their names. ``w``: (id, term, weight)."""
    found = cut_lineage(filters.find_products(products, queries, name_col, id_col=id_col), "found-products")
    best = sparse_topn.top_similar(w, id_col, top, found.select(F.col("id").alias(id_col)))
    hits = found.withColumnRenamed("id", "id1").join(best, "id1")
    return attach_names(hits, products, sim_key="id2", key=id_col, cols=(name_col,)).select("qid", "id1", "id2", name_col, "rank", "score")


#: Words of a Word2Vec model. Its fit holds them all on the driver and sends every task a copy.
WORD2VEC_MAX_WORDS = 2_000_000


def word2vec(df: DataFrame, tokens_col: str, out: str, size: int, seed: int, min_count: int) -> Word2Vec:
    """The estimator, trained in as many tasks as the session has slots; too many words raise before the fit."""
    counts = df.select(F.explode(tokens_col).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = counts.where(F.col("n") >= min_count).count()
    if words > WORD2VEC_MAX_WORDS:
        raise ValueError(f"{words} words occur {min_count} times or more; Word2Vec takes {WORD2VEC_MAX_WORDS}: raise min_count")
    return Word2Vec(vectorSize=size, seed=seed, minCount=min_count, inputCol=tokens_col, outputCol=out,
                    numPartitions=df.sparkSession.sparkContext.defaultParallelism)


def fit_word2vec(df: DataFrame, tokens_col: str = "tokens", out: str = "features", size: int = 100,
                 seed: int = 42, min_count: int = 5):
    """M4: Word2Vec document vectors (mean of word vectors; unknown words ignored)."""
    return word2vec(df, tokens_col, out, size, seed, min_count).fit(df)


def fit_clusters(df: DataFrame, features_col: str = "features", k: int = 3, seed: int = 42):
    """M5: StandardScaler (std only) then KMeans(k) on the *unscaled* features, as the reference does."""
    pipe = Pipeline(stages=[StandardScaler(inputCol=features_col, outputCol="scaledFeatures"),
                            KMeans(k=k, seed=seed, featuresCol=features_col)])
    return pipe.fit(df)


def search_two_level(vectors: DataFrame, queries: DataFrame, k: int, n_clusters: int | None = None,
                     seed: int = 42, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """The k nearest vectors of every query through a cluster index, exactly (see ``two_level``).

    ``queries`` has the same columns as ``vectors``; a query that is itself a vector finds itself first."""
    index = two_level.build(vectors, n_clusters, seed=seed, id_col=id_col, vec_col=vec_col)
    return two_level.search(index, queries.select(F.col(id_col).alias("qid"), vec_col), k, vec_col=vec_col)


def recommend_by_cosine(model, products: DataFrame, queries: DataFrame, n: int = 5, id_col: str = "id",
                        tokens_col: str = "tokens") -> DataFrame:
    """M8: Word2Vec document vectors, top-n products by cosine per query (query not excluded).

    ``products``: (id, tokens); ``queries``: (qid, tokens) - queries are data, not a Python string.
    A query whose words are all unknown has a zero vector and gets no recommendation.
    """
    from pyspark.ml.functions import vector_to_array

    from reviewlake.operators import topk

    out = model.getOutputCol()
    vec = model.transform(products.select(id_col, tokens_col)).select(id_col, vector_to_array(out).alias("vec"))
    qv = model.transform(queries.select("qid", tokens_col)).select("qid", vector_to_array(out).alias("vec"))
    return topk.knn(vec, qv, n, metric="cosine", id_col=id_col)


def fit_vector_model(products: DataFrame, tokens_col: str = "tokens", size: int = 100, seed: int = 42,
                        min_count: int = 5):
    """M11 (training side): Word2Vec + L2 Normalizer as one saved-and-loaded PipelineModel."""
    from pyspark.ml.feature import Normalizer
    return Pipeline(stages=[word2vec(products, tokens_col, "features", size, seed, min_count),
                            Normalizer(inputCol="features", outputCol="normalized_vectors", p=2.0)]).fit(products)


def recommend_saved_model(model, products: DataFrame, queries: DataFrame, k: int = 100, id_col: str = "id",
                       name_col: str = "name") -> DataFrame:
    """Saved pipeline -> unit vectors -> k nearest product names per query (by id, never position)."""
    from pyspark.ml.functions import vector_to_array

    from reviewlake.operators import topk

    vec = model.transform(products).select(id_col, vector_to_array("normalized_vectors").alias("vec"))
    qv = model.transform(queries).select(F.col(id_col).alias("qid"), vector_to_array("normalized_vectors").alias("vec"))
    hits = topk.knn(vec, qv, k, metric="l2", id_col=id_col)
    return hits.join(products.select(id_col, name_col), id_col)


def stopwords_remover(words: list[str], input_col: str = "tokens", output_col: str = "filtered"):
    """N12 (MLlib form): StopWordsRemover with a given list (case-insensitive, as by default)."""
    return StopWordsRemover(inputCol=input_col, outputCol=output_col, stopWords=list(words))
