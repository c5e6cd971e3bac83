"""Queries ``opN_<name>``: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import (
    backoff_lm, block_topk, byte_bpe, infilling, lang_crf, license_scan, mixing, ngram_join, packing, secret_scan, spelling,
    stream_dedup, substring_dedup,
)


def _documents(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/documents.parquet")


def op1_ngram_join(spark: SparkSession, base: str) -> DataFrame:
    """Near-duplicate groups of all documents: Jaccard similarity of five-word shingles of at least 0.8."""
    return ngram_join.join_groups(_documents(spark, base)).select("doc_id", "n_shingles", "component_id", "set_size")


def op2_packing(spark: SparkSession, base: str) -> DataFrame:
    """Packing of all documents into sequences of at most 2048 tokens."""
    return packing.pack_documents(_documents(spark, base))


def op3_license_scan(spark: SparkSession, base: str) -> DataFrame:
    """Licence notices of all documents with matched coverage and spans."""
    return license_scan.scan(_documents(spark, base))


def op4_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Removal of the words of every 35-word window that also starts elsewhere."""
    return substring_dedup.remove_repeats(_documents(spark, base), with_text=False)


def _remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op5_language(spark: SparkSession, base: str) -> DataFrame:
    """Language of every document; ids whose remainder by 5 is 0 are held out of the fit."""
    docs = _documents(spark, base).withColumn("held_out", F.coalesce(_remainder(5) == 0, F.lit(False)))
    found = lang_crf.learn_and_predict(docs, _remainder(5) != 0, carry=["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Exact dedup: one row per document with its group, from the streaming keyed state."""
    return stream_dedup.deduplicate(_documents(spark, base)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_exact_topk(spark: SparkSession, base: str) -> DataFrame:
    """Exact top-20 inner-product search of every vector whose id is divisible by 20."""
    vectors = block_topk.quantised(spark.read.parquet(f"{base}/embeddings.parquet"), "vec_id", "embedding")
    return block_topk.top_k(vectors, vectors.where("id % 20 = 0"), k=20).withColumnRenamed("id", "vec_id")


def op8_lm_score(spark: SparkSession, base: str) -> DataFrame:
    """Log-probability of every document; ids whose remainder by 7 is 2 are held out of the model."""
    docs = _documents(spark, base)
    found = backoff_lm.learn_and_score(docs, _remainder(7) != 2)
    return found.select("doc_id", F.coalesce(_remainder(7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


def op9_mixing(spark: SparkSession, base: str) -> DataFrame:
    """Documents in the order and number of the temperature mixture of their sources."""
    return mixing.mix(_documents(spark, base))


def op10_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    """Secret findings of every document, with ownership frequency."""
    return secret_scan.summary(secret_scan.scan(_documents(spark, base)))


def op11_spelling(spark: SparkSession, base: str) -> DataFrame:
    """Spelling variants of every frequent word of all documents: near words, forms and roots."""
    return spelling.variants(_documents(spark, base))


def op12_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes that the ids decode to."""
    found = byte_bpe.round_trip(_documents(spark, base))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "n_split")


def op13_infilling(spark: SparkSession, base: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and the text rebuilt from it."""
    found = infilling.fill_in_middle(_documents(spark, base))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                        digest(infilling.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


LLM_QUERIES = {q.__name__: q for q in (
    op1_ngram_join, op2_packing, op3_license_scan, op4_substring_dedup, op5_language, op6_exact_dedup,
    op7_exact_topk, op8_lm_score, op9_mixing, op10_secret_scan, op11_spelling, op12_byte_bpe, op13_infilling)}

_OP6 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS n
  FROM documents),
g AS (
  SELECT n, count(*) AS group_size, arg_min(doc_id, (-length(t), doc_id)) AS keep_id FROM d GROUP BY n)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.n) AS text_sha256
FROM d JOIN g USING (n)
"""

_OP7 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

_OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
k AS (SELECT doc_id, list(t ORDER BY t) AS k FROM s GROUP BY doc_id),
z AS (SELECT k, count(*) AS set_size FROM k GROUP BY k)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id,
       coalesce(z.set_size, 1) AS set_size
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN z USING (k)
"""

_OP4 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, i, w[i:i + 34] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
d AS (SELECT k FROM v GROUP BY k HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM v JOIN d USING (k)),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
a AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM w LEFT JOIN g USING (doc_id)),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM a),
t AS (SELECT p.doc_id, string_agg(x, ' ' ORDER BY p.i) AS kept FROM p ANTI JOIN c ON c.doc_id = p.doc_id AND c.i = p.i GROUP BY p.doc_id)
SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM a LEFT JOIN t USING (doc_id)
"""


def _op10() -> str:
    """Spans from the pieces between matches; owner-specific generic tokens beside the base findings."""
    def kind(rank: int, name: str, pattern: str, group: int, least: int) -> str:
        p = pattern.replace("'", "''")
        return f"""
SELECT doc_id, owner, {rank} AS k, '{name}' AS kind, {least} AS least, string_split_regex(t, '{p}') AS gap,
       regexp_extract_all(t, '{p}') AS hit, regexp_extract_all(t, '{p}', {group}) AS val FROM d"""
    kinds = [*enumerate(secret_scan.KINDS), (len(secret_scan.KINDS), ("live", secret_scan.GENERIC, 0, 20))]
    n = len(secret_scan.KINDS)
    return f"""
WITH d AS (SELECT doc_id, source AS owner, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(kind(i, *x) for i, x in kinds)}),
e AS (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM m WHERE len(hit) > 0),
f AS (SELECT doc_id, owner, k, kind, least, val[i] AS val, len(hit[i]) AS n,
             CAST(list_sum([len(x) FOR x IN gap[:i]]) + coalesce(list_sum([len(x) FOR x IN hit[:i - 1]]), 0) AS BIGINT) AS a FROM e),
s AS (SELECT doc_id, owner, k, kind, val, a, a + n AS b FROM f WHERE len(val) >= least AND (k < {n}
        OR (len(list_distinct(string_split(val, ''))) >= {secret_scan.MIN_DISTINCT} AND regexp_matches(val, '[A-Za-z]')
            AND len(regexp_replace(val, '[^0-9]', '', 'g')) >= {secret_scan.MIN_DIGITS}))),
o AS (SELECT val, count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INTEGER)) AS repositories,
             count(DISTINCT owner) + max(CAST(owner IS NULL AS INTEGER)) <= {secret_scan.MAX_OWNERS} AS own FROM s GROUP BY val),
x AS (SELECT s.*, o.own, o.repositories FROM s JOIN o USING (val)),
y AS (SELECT x.* FROM x WHERE k < {n} OR (own AND NOT EXISTS (
        SELECT 1 FROM s WHERE s.doc_id = x.doc_id AND s.k < {n} AND s.a < x.b AND x.a < s.b))),
z AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k < {n}) AS base,
             string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans FROM y GROUP BY doc_id),
q AS (SELECT doc_id, count(*) FILTER (own) AS n_owner_specific, count(*) FILTER (NOT own) AS n_copied,
             CAST(max(repositories) FILTER (own) AS BIGINT) AS most_repositories FROM x GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_owner_specific, 0) AS n_owner_specific, coalesce(n_copied, 0) AS n_copied,
       coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN q USING (doc_id)
"""


#: CRC-32 over the bytes of ``<doc_id>:<run>`` by its table, words that share a text with one code point cut out of
#: either or both at one place (so they are one edit apart), and the chain of forms.
_OP11 = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(n AS BIGINT))) AS t),
u AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
d AS (SELECT doc_id, r, count(*) AS k, hex(encode(doc_id || ':' || r)) AS x FROM u WHERE length(r) >= 5 GROUP BY doc_id, r),
h AS (SELECT r, k, xor(list_reduce([CAST(('0x' || x[2 * i - 1:2 * i]) AS BIGINT) FOR i IN range(1, length(x) // 2 + 1)],
        lambda c, b: xor(c // 256, t.t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM d, t),
v AS (SELECT CASE WHEN h % 97 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, k FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
c AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word AS word, b.word AS other FROM c a JOIN c b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
      UNION SELECT c.word, w.word FROM c JOIN w ON c.cut = w.word UNION SELECT w.word, c.word FROM c JOIN w ON c.cut = w.word),
b AS (SELECT p.word, count(*) AS n_near, arg_min(w.word, (-w.n, w.word)) AS best, max(w.n) AS best_n
      FROM p JOIN w ON w.word = p.other GROUP BY p.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
             CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
z AS (SELECT word, word AS at FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON f.word = z.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, z.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN z ON z.word = f.word JOIN f l ON l.word = z.at AND l.form IS NULL
"""

_OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS x,
         regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u FROM documents),
h AS (SELECT *, len(u) AS n, [CAST('0x' || x[8 * i + 1:8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM d),
f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM s
"""

LLM_ORACLES = {"op1_ngram_join": _OP1, "op4_substring_dedup": _OP4, "op6_exact_dedup": _OP6, "op7_exact_topk": _OP7,
               "op10_secret_scan": _op10(), "op11_spelling": _OP11, "op13_infilling": _OP13}
