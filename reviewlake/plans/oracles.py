"""DuckDB oracle SQL for the registered queries (same tables, same fixed values, RE2 regexes).

RE2 has neither back-references nor look-arounds, so the oracle expresses the two rules that need
them differently: doubled-character collapse filters a character list; whole-word phrase removal
doubles every space first so that neighbouring matches never share a boundary character.
"""

from __future__ import annotations

from reviewlake.functions import text as tx
from reviewlake.plans import queries as Q

WS = tx.WS_CHARS
WORD = tx.WORD_CHARS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def collapse_ws(x: str) -> str:
    return f"regexp_replace({x}, '[{WS}]+', ' ', 'g')"


def drop_punct(x: str, repl: str = "") -> str:
    return f"regexp_replace({x}, '[^{WORD}{WS}]', {lit(repl)}, 'g')"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def clean_base(x: str) -> str:
    return f"trim(lower({drop_punct(collapse_ws(x))}))"


def collapse_doubles(x: str, cls: str) -> str:
    """Drop every character equal to its predecessor when it is in ``cls`` (no back-references)."""
    return (f"(SELECT array_to_string(list_filter(l, lambda c, i: NOT (i > 1 AND c = l[i - 1] "
            f"AND regexp_full_match(c, '{cls}'))), '') FROM (SELECT str_split({x}, '') AS l))")


def map_words(x: str, case_expr) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: {case_expr('w')}), ' ')"


def remove_whole_words(x: str, words) -> str:
    alt = "|".join(words).replace(" ", "  ")
    doubled = f"replace({x}, ' ', '  ')"
    removed = f"regexp_replace({doubled}, '(^| )(?:{alt})( |$)', '\\1\\2', 'g')"
    return f"replace({removed}, '  ', ' ')"


def review_slang(x: str) -> str:
    t = f"lower({drop_punct(collapse_ws(x))})"
    t = collapse_doubles(t, "[A-Za-z]")
    by_value: dict[str, list[str]] = {}
    for k, v in tx.REVIEW_SLANG.items():
        by_value.setdefault(v, []).append(k)

    def case(w):
        parts = []
        for v, keys in by_value.items():
            cond = f"{w} IN {in_list(keys)}"
            if v == tx.REVIEW_SLANG_OK_PREFIX:
                cond = f"({cond} OR regexp_full_match({w}, 'ok[a-zA-Z]+'))"
            parts.append(f"WHEN {cond} THEN {lit(v)}")
        return "CASE " + " ".join(parts) + f" ELSE {w} END"
    return f"trim({map_words(t, case)})"


def clean_collapse(x: str) -> str:
    t = f"lower({drop_punct(collapse_ws(x), ' ')})"
    t = collapse_doubles(t, f"[{WORD}]")
    ok = in_list(tx.COLLAPSE_OK_WORDS)
    t = map_words(t, lambda w: f"CASE WHEN {w} IN {ok} OR regexp_full_match({w}, 'ok[{WORD}]+') "
                               f"THEN {lit(tx.SATISFIED)} ELSE {w} END")
    return f"coalesce(trim({t}), '')"


def clean_product(x: str) -> str:
    t = f"lower({drop_punct(collapse_ws(f'coalesce({x}, {lit(chr(39) * 0)})'))})"
    return f"trim({remove_whole_words(t, tx.PRODUCT_PHRASES)})"


def clean_name(x: str) -> str:
    t = drop_punct(strip_ws(f"lower({x})"))
    for p in tx.NAME_PHRASES:
        t = f"replace({t}, {lit(p)}, '')"
    return t


def label_int(x: str) -> str:
    return (f"CASE WHEN {x} IN (1, 2) THEN 'negative' WHEN {x} = 3 THEN 'neutral' "
            f"WHEN {x} IN (4, 5) THEN 'positive' ELSE 'Unknown' END")


def label_str(x: str) -> str:
    return (f"CASE WHEN {x} IN ('1', '2') THEN 'negative' WHEN {x} = '3' THEN 'neutral' "
            f"WHEN {x} IN ('4', '5') THEN 'positive' ELSE 'Unknown' END")


def contains_any(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, {lit(w)})" for w in words) + ")"


def repair_title(t: str, label: str) -> str:
    """``t`` is the already-cleaned title (N5), ``label`` the string label."""
    k = tx.TITLE_KEYWORDS
    positive = f"replace({remove_whole_words(t, tx.TITLE_POSITIVE_DROP_WORDS)}, " \
               f"{lit(tx.TITLE_POSITIVE_SWAP[0])}, {lit(tx.TITLE_POSITIVE_SWAP[1])})"
    return (f"CASE WHEN {label} = 'negative' AND {contains_any(t, k['negative'])} THEN {lit(tx.TITLE_NEGATIVE_PREFIX)} || {t} "
            f"WHEN {label} = 'positive' AND {contains_any(t, k['positive'])} THEN {positive} "
            f"WHEN {label} = 'neutral' AND {contains_any(t, k['neutral'])} THEN {lit(tx.TITLE_NEUTRAL_VALUE)} "
            f"ELSE {t} END")


def decode_entities(x: str) -> str:
    """One left-to-right pass over ``&``-separated pieces (named, numeric, legacy names without ';')."""
    from html.entities import html5
    legacy = "|".join(sorted((k for k in html5 if k[-1] != ";"), key=len, reverse=True))
    keys, values = zip(*sorted((k.rstrip(";"), ch) for k, ch in html5.items() if k[-1] == ";"), strict=True)
    table = f"MAP([{', '.join(map(lit, keys))}], [{', '.join(map(lit, values))}])"

    def case(v: str) -> str:
        return f"names[{v}]"
    semi = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    num = "regexp_extract(p, '^#(?:[0-9]+|[xX][0-9a-fA-F]+);?', 0)"
    old = f"regexp_extract(p, '^({legacy})', 1)"
    digits = f"regexp_extract({num}, '[0-9a-fA-F]+', 0)"
    code = (f"(CASE WHEN regexp_matches({num}, '^#[xX]') THEN TRY_CAST('0x' || {digits} AS BIGINT) "
            f"ELSE TRY_CAST({digits} AS BIGINT) END)")
    over = " ".join(f"WHEN {code} = {k} THEN {lit(ch)}" for k, ch in tx.NUMERIC_REF_OVERRIDES.items())
    cp = (f"(CASE {over} WHEN {code} IS NULL OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) "
          f"WHEN {code} BETWEEN 1 AND 8 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} BETWEEN 127 AND 159 "
          f"OR {code} BETWEEN 64976 AND 65007 OR {code} % 65536 >= 65534 THEN '' "
          f"ELSE chr(CAST({code} AS INTEGER)) END)")
    piece = (f"CASE WHEN {case(semi)} IS NOT NULL THEN {case(semi)} || substr(p, length({semi}) + 2) "
             f"WHEN {num} <> '' THEN {cp} || substr(p, length({num}) + 1) "
             f"WHEN {old} <> '' THEN {case(old)} || substr(p, length({old}) + 1) "
             f"ELSE '&' || p END")
    return (f"CASE WHEN contains({x}, '&') THEN (SELECT array_to_string(list_concat([parts[1]], "
            f"list_transform(parts[2:], lambda p: {piece})), '') "
            f"FROM (SELECT string_split({x}, '&') AS parts, {table} AS names)) "
            f"ELSE {x} END")


def html_text(x: str) -> str:
    t = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    t = f"regexp_replace({t}, '(?is)<script[^>]*>.*?</script\\s*>', '', 'g')"
    t = f"regexp_replace({t}, '(?is)<style[^>]*>.*?</style\\s*>', '', 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]*>', '', 'g')"
    t = decode_entities(t)
    for s in tx.HTML_TEXT_BLANKED:
        t = f"replace({t}, {lit(s)}, ' ')"
    return strip_ws(t)


TITLE = "split_part(text, chr(10), 1)"
TOKENS = f"coalesce(string_split({clean_base('text')}, ' '), [])"

PRODUCTS = f"""
stats AS (
  SELECT l_partkey AS p_partkey,
         arg_max(l_suppkey, struct_pack(a := l_shipdate, b := l_orderkey, c := l_linenumber)) AS last_supp,
         max(l_shipdate) AS last_ship,
         CAST(trunc(sum(l_quantity)) AS BIGINT) AS sold, count(*) AS n_lines,
         avg(1 + CAST(trunc(l_quantity) AS INTEGER) % 5) AS avg_star
  FROM lineitem GROUP BY l_partkey),
products AS (
  SELECT p.p_partkey AS id, p.p_name AS name, p.p_type, p.p_retailprice,
         {html_text("'<div><p>' || p.p_name || ' &amp; ' || p.p_type || '</p><br>size ' || CAST(p.p_size AS VARCHAR) || '</div>'")} AS description,
         s.sold, s.n_lines, s.avg_star, p.p_size,
         su.s_suppkey, su.s_name, su.s_acctbal, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name, p.p_brand,
         strftime(s.last_ship, '%Y-%m-%d') AS time
  FROM part p LEFT JOIN stats s ON s.p_partkey = p.p_partkey
  LEFT JOIN supplier su ON su.s_suppkey = s.last_supp
  LEFT JOIN nation n ON n.n_nationkey = su.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)
"""

STARS = """
s AS (SELECT l_partkey AS product_id, 1 + CAST(trunc(l_quantity) AS INTEGER) % 5 AS star FROM lineitem),
c AS (SELECT product_id, star, count(*) AS cnt FROM s GROUP BY 1, 2),
t AS (SELECT product_id, CAST(sum(cnt) AS BIGINT) AS total, CAST(sum(star * cnt) AS BIGINT) AS star_sum FROM c GROUP BY 1)
"""


def _overview_cols(defaults: bool) -> str:
    cols = []
    for n in range(1, 6):
        cnt = f"max(CASE WHEN c.star = {n} THEN c.cnt END)"
        pct = f"max(CASE WHEN c.star = {n} THEN c.cnt * CAST(100 AS DOUBLE) / t.total END)"
        if defaults:
            cnt, pct = f"coalesce({cnt}, 0)", f"coalesce({pct}, 0.0)"
        cols += [f"CAST({cnt} AS BIGINT) AS stars_{n}_count", f"CAST({pct} AS DOUBLE) AS stars_{n}_percent"]
    return ", ".join(cols)


def _vec_unit(e: str) -> str:
    d = f"list_transform({e}, lambda x: CAST(x AS DOUBLE))"
    nrm = f"sqrt(list_sum(list_transform({d}, lambda x: x * x)))"
    return f"list_transform({d}, lambda x: CASE WHEN {nrm} > 0 THEN x / {nrm} ELSE 0.0 END)"


def _sqdist(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"


def _tfidf_cte(tokens_sql: str) -> str:
    """``tokens_sql`` selects (id, toks)."""
    return f"""
d AS ({tokens_sql}),
n AS (SELECT count(*) AS n FROM d),
dfq AS (SELECT term, count(*) AS df FROM (SELECT id, unnest(list_distinct(toks)) AS term FROM d) GROUP BY term),
idf AS (SELECT term, df, ln((n.n + 1) / (df + 1)) AS idf FROM dfq, n),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(toks) AS term FROM d) GROUP BY id, term),
w AS (SELECT tf.id, tf.term, tf.tf, tf.tf * idf.idf AS weight FROM tf JOIN idf USING (term))
"""


PRODUCT_TERMS = f"""
WITH {PRODUCTS.strip()},
meta AS (SELECT id, {clean_product('name')} || ' ' || r_name || ' ' AS metadata FROM products),
{_tfidf_cte("SELECT id, coalesce(string_split(metadata, ' '), []) AS toks FROM meta").strip()}
"""


def sql() -> dict[str, str]:
    cb = clean_base("text")
    o: dict[str, str] = {}
    o["label_counts"] = f"""
SELECT label, count(*) AS n_reviews FROM (
  SELECT {label_int('doc_id % 6')} AS label, {cb} AS clean
  FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^{WS}]'))
WHERE clean <> '' AND label <> 'Unknown' GROUP BY label"""
    o["reviews_exploded"] = f"""
SELECT doc_id // 20 AS product_id, doc_id AS id, coalesce({TITLE}, '') AS title,
       CAST(doc_id % 6 AS DOUBLE) AS score, CAST(doc_id % 6 AS INTEGER) AS rating, 'approved' AS status,
       doc_id AS author_id, CAST(0 AS BIGINT) AS purchased_at
FROM documents"""
    o["page_requests"] = """
SELECT product_id, CAST(page AS INTEGER) AS page FROM (
  SELECT p_partkey AS product_id, unnest(generate_series(1, p_size)) AS page FROM part WHERE p_size >= 1)"""
    o["listing_ids"] = "SELECT p_partkey // 100 AS page, p_partkey AS id FROM part"
    o["categories_exploded"] = "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation"
    o["first_n"] = f"SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT {Q.FIRST_N}"
    o["range_scan"] = f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey >= {Q.RANGE_START_KEY}
ORDER BY o_orderkey LIMIT {Q.RANGE_LIMIT}"""
    o["lookup_by_keys"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
    o["messages_parsed"] = "SELECT event_id, user_id AS id, event_type AS name FROM events"
    o["product_document"] = f"""
WITH {PRODUCTS.strip()}
SELECT concat_ws('_', time, CAST(id AS VARCHAR)) AS key, id, name, p_retailprice AS price, time,
       p_retailprice AS original_price, sold AS all_time_quantity_sold, avg_star AS rating_average,
       n_lines AS review_count, CAST(p_size AS BIGINT) AS favourite_count, CAST(NULL AS BIGINT) AS day_ago_created,
       description, s_suppkey AS store_id, s_acctbal > 0 AS is_best_store, s_name AS seller_name,
       p_retailprice AS seller_price, TRY_CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) AS brand_id,
       p_brand AS brand_name, CAST(n_nationkey AS BIGINT) AS category_id, n_name AS category_name,
       CAST(r_regionkey AS BIGINT) AS category_parent_id, r_name AS category_parent_name
FROM products"""
    o["rating_document"] = f"""
SELECT doc_id AS id, {TITLE} AS title, text AS content, doc_id AS customer_id, CAST(doc_id % 6 AS INTEGER) AS rating
FROM documents"""
    o["overview_document"] = f"""
WITH {STARS.strip()}
SELECT t.product_id, p.p_name AS name_product, {_overview_cols(False)},
       t.star_sum / t.total AS rating_average, t.total AS reviews_count,
       t.total AS review_photo_total, CAST(0 AS BIGINT) AS review_photo_total_photo
FROM t JOIN c USING (product_id) LEFT JOIN part p ON p.p_partkey = t.product_id
GROUP BY t.product_id, p.p_name, t.star_sum, t.total"""
    o["defaults_applied"] = f"""
WITH {STARS.strip()}
SELECT t.product_id, {_overview_cols(True)}
FROM t JOIN c USING (product_id) GROUP BY t.product_id, t.total"""
    o["cells_unpivoted"] = """
SELECT n_nationkey AS row_key, 'info:n_name' AS "column", n_name AS value FROM nation
UNION ALL SELECT n_nationkey, 'info:n_regionkey', CAST(n_regionkey AS VARCHAR) FROM nation"""
    o["cells_to_map"] = f"""
WITH {STARS.strip()}
SELECT product_id AS row_key, CAST(star AS VARCHAR) AS star, 'count' AS attr, CAST(cnt AS VARCHAR) AS value FROM c"""
    o["resume_after"] = f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey >= (SELECT min(o_orderkey) FROM orders WHERE o_custkey = {Q.CURSOR_CUSTOMER})"""
    o["take_until"] = f"""
SELECT o_orderkey, o_custkey FROM orders, (SELECT min(o_orderkey) AS stop FROM orders WHERE o_custkey = {Q.CURSOR_CUSTOMER}) s
WHERE s.stop IS NULL OR o_orderkey <= s.stop"""
    o["denylist_anti"] = f"""
SELECT event_id, user_id, event_type FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '{Q.DONE_CUTOFF}')"""
    o["not_yet_sent"] = f"""
SELECT DISTINCT user_id AS id, event_type AS name FROM events WHERE ts >= TIMESTAMP '{Q.HISTORY_CUTOFF}'
EXCEPT SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '{Q.HISTORY_CUTOFF}'"""
    o["clean_base"] = f"SELECT doc_id, {cb} AS clean, coalesce({cb}, '') AS clean_safe FROM documents"
    o["clean_boilerplate"] = f"""
WITH top AS (SELECT line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
             WHERE line <> '' GROUP BY line ORDER BY count(*) DESC, line LIMIT 1)
SELECT doc_id, coalesce({clean_base("replace(text, (SELECT line FROM top), '')")}, '') AS clean FROM documents"""
    o["clean_review_slang"] = f"SELECT doc_id, {review_slang('text')} AS clean FROM documents"
    o["clean_collapse"] = f"SELECT doc_id, {clean_collapse('text')} AS clean FROM documents"
    o["clean_product"] = f"SELECT doc_id, {clean_product('text')} AS clean FROM documents"
    o["clean_name"] = f"SELECT p_partkey AS id, {clean_name('p_name')} AS name FROM part"
    o["clean_name_text"] = f"SELECT doc_id, {clean_name('text')} AS clean FROM documents"
    o["title_repair"] = f"""
SELECT id, {repair_title('t', 'label')} AS title FROM (
  SELECT doc_id AS id, {clean_collapse(TITLE)} AS t, {label_str('CAST(doc_id % 6 AS VARCHAR)')} AS label FROM documents)"""
    o["html_text"] = f"SELECT page_id, {html_text('html')} AS text FROM pages"
    o["stopwords_removed"] = f"""
WITH d AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
stop AS (SELECT w FROM (SELECT unnest(toks) AS w FROM d) WHERE w <> '' GROUP BY w
         ORDER BY count(*) DESC, w LIMIT {Q.STOPWORDS_TOP}),
sl AS (SELECT list(w) AS words FROM stop),
k AS (SELECT doc_id, list_filter(toks, lambda x: NOT list_contains(sl.words, lower(x))) AS kept FROM d, sl)
SELECT doc_id, CAST(len(kept) AS INTEGER) AS n_kept, array_to_string(kept, ' ') AS text FROM k"""
    o["enrich_left"] = """
SELECT DISTINCT l_partkey AS product_id, p_name AS name_product FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"""
    o["dictionary_join"] = """
WITH d AS (SELECT CAST(c_nationkey AS VARCHAR) AS k, arg_max(c_name, c_custkey) AS name FROM customer GROUP BY 1)
SELECT s_suppkey, coalesce(d.name, '') AS nation_contact FROM supplier LEFT JOIN d ON CAST(s_nationkey AS VARCHAR) = d.k"""
    o["distinct_reviews"] = f"""
SELECT DISTINCT title || ' ' || content AS content, label, rating FROM (
  SELECT {repair_title('t', 'label')} AS title, c AS content, label, rating FROM (
    SELECT {clean_collapse(TITLE)} AS t, {clean_collapse('text')} AS c,
           {label_str('CAST(doc_id % 6 AS VARCHAR)')} AS label, CAST(doc_id % 6 AS VARCHAR) AS rating FROM documents))"""
    o["char_freq"] = """
SELECT ch, count(*) AS frequency FROM (SELECT unnest(str_split(text, '')) AS ch FROM documents)
WHERE ch <> '' GROUP BY ch"""
    o["word_freq"] = f"""
SELECT word, count(*) AS frequency FROM (SELECT unnest({TOKENS}) AS word FROM documents)
WHERE word <> '' GROUP BY word"""
    tok_docs = f"SELECT doc_id AS id, {TOKENS} AS toks FROM documents"
    o["idf"] = f"WITH {_tfidf_cte(tok_docs).strip()} SELECT term, df, round(idf, 6) AS idf FROM idf"
    o["tfidf"] = (f"WITH {_tfidf_cte(tok_docs).strip()} "
                  "SELECT id AS doc_id, term, tf, round(weight, 6) AS tfidf FROM w")
    o["filter_counts"] = f"SELECT count(*) AS rows_before, CAST(count_if({cb} <> '') AS BIGINT) AS rows_after FROM documents"
    o["metrics"] = """
WITH cm AS (SELECT quality AS l, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
a AS (SELECT l AS c, sum(n) AS actual FROM cm GROUP BY 1),
pr AS (SELECT p AS c, sum(n) AS predicted FROM cm GROUP BY 1),
tp AS (SELECT l AS c, n AS tp FROM cm WHERE l = p),
per AS (SELECT a.c, a.actual, coalesce(tp.tp, 0) AS tp, coalesce(pr.predicted, 0) AS predicted,
               CASE WHEN coalesce(pr.predicted, 0) > 0 THEN coalesce(tp.tp, 0) / pr.predicted ELSE 0.0 END AS prec,
               coalesce(tp.tp, 0) / a.actual AS rec
        FROM a LEFT JOIN tp USING (c) LEFT JOIN pr USING (c)),
m AS (SELECT sum(tp) / sum(actual) AS accuracy,
             sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END * actual) / sum(actual) AS weighted_f1,
             sum(prec * actual) / sum(actual) AS weighted_precision FROM per)
SELECT round(accuracy, 9) AS accuracy, round(weighted_f1, 9) AS weighted_f1,
       round(weighted_precision, 9) AS weighted_precision, round(1 - accuracy, 9) AS error FROM m"""
    o["cluster_count"] = "SELECT count(DISTINCT label) AS n_clusters FROM embeddings"
    o["upsert_latest"] = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    o["merge_upsert"] = """
WITH c AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
u AS (
  SELECT c_custkey, NULL AS c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM c WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal, c_mktsegment FROM c WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey, c_name, c_acctbal + 2, 'AUTO' FROM c WHERE c_mktsegment = 'AUTOMOBILE')
SELECT coalesce(u.c_custkey, c.c_custkey) AS c_custkey, coalesce(u.c_name, c.c_name) AS c_name,
       coalesce(u.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(u.c_mktsegment, c.c_mktsegment) AS c_mktsegment
FROM c FULL OUTER JOIN u ON c.c_custkey = u.c_custkey"""
    o["daily_snapshot"] = """
WITH r AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS time, l_partkey AS id, l_quantity AS quantity,
                  l_extendedprice AS price, l_orderkey, l_linenumber, l_linestatus FROM lineitem),
b1 AS (SELECT * FROM r WHERE l_linestatus = 'O'
       QUALIFY row_number() OVER (PARTITION BY time, id ORDER BY l_orderkey DESC, l_linenumber DESC) = 1),
b2 AS (SELECT * FROM r WHERE l_linestatus = 'F'
       QUALIFY row_number() OVER (PARTITION BY time, id ORDER BY l_orderkey DESC, l_linenumber DESC) = 1),
m AS (SELECT coalesce(b2.time, b1.time) AS time, coalesce(b2.id, b1.id) AS id,
             coalesce(b2.quantity, b1.quantity) AS quantity, coalesce(b2.price, b1.price) AS price
      FROM b1 FULL OUTER JOIN b2 ON b1.time = b2.time AND b1.id = b2.id)
SELECT concat_ws('_', time, CAST(id AS VARCHAR)) AS key, time, id, quantity, price FROM m"""
    o["unit_vectors"] = f"""
SELECT id, CAST(dim AS INTEGER) AS dim, round(u[dim + 1], 6) AS value FROM (
  SELECT vec_id AS id, {_vec_unit('embedding')} AS u FROM embeddings),
  LATERAL (SELECT unnest(generate_series(0, len(u) - 1)) AS dim)"""
    knn_pairs = f"""
WITH u AS (SELECT vec_id AS id, {_vec_unit('embedding')} AS v FROM embeddings),
p AS (SELECT a.id AS qid, b.id AS id, greatest({_sqdist('a.v', 'b.v')}, 0.0) AS score FROM u a, u b),
r AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9), id) AS rank FROM p)"""
    o["knn_l2"] = f"{knn_pairs} SELECT qid, id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS dist FROM r WHERE rank <= {Q.KNN_K}"
    o["similar_items"] = f"{knn_pairs} SELECT qid, id, round(score, 6) AS dist FROM r WHERE rank <= {Q.KNN_K} AND id <> qid"
    o["cosine_topk"] = f"""
WITH e AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
p AS (SELECT a.id AS qid, b.id AS id,
             {_dot('a.v', 'b.v')} / (sqrt({_dot('a.v', 'a.v')}) * sqrt({_dot('b.v', 'b.v')})) AS score FROM e a, e b),
r AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank
      FROM p WHERE score IS NOT NULL AND NOT isnan(score))
SELECT qid, id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS cosine FROM r WHERE rank <= {Q.COSINE_K}"""
    o["similar_tfidf"] = f"""
{PRODUCT_TERMS.strip()},
pairs AS (SELECT a.id AS id1, b.id AS id2, sum(a.weight * b.weight) AS score
          FROM w a JOIN w b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2),
r AS (SELECT id1, id2, score, row_number() OVER (PARTITION BY id1 ORDER BY round(score, 9) DESC, id2) AS rank FROM pairs)
SELECT id1, id2, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= {Q.TFIDF_TOP}"""
    o["similar_documents"] = f"""
WITH t AS (SELECT doc_id AS id, unnest(string_split(text, ' ')) AS term FROM documents),
c AS (SELECT id, term, count(*) AS tf FROM t GROUP BY id, term),
i AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM c GROUP BY term),
r AS (SELECT id, term, tf * idf AS weight FROM c JOIN i USING (term)),
l AS (SELECT id, sqrt(sum(weight * weight)) AS length FROM r GROUP BY id),
w AS (SELECT id, term, CASE WHEN length > 0 THEN weight / length ELSE 0.0 END AS weight FROM r JOIN l USING (id)),
pairs AS (SELECT a.id AS id1, b.id AS id2, sum(a.weight * b.weight) AS score
          FROM w a JOIN w b ON a.id % 50 = 0 AND a.term = b.term AND a.id <> b.id GROUP BY 1, 2),
k AS (SELECT id1, id2, score, row_number() OVER (PARTITION BY id1 ORDER BY round(score, 9) DESC, id2) AS rank FROM pairs)
SELECT id1, id2, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM k WHERE rank <= {Q.TFIDF_TOP}"""
    o["recommend_text"] = f"""
{PRODUCT_TERMS.strip()},
q AS (SELECT min(id) AS qid FROM products WHERE contains(name, {lit(Q.RECOMMEND_TEXT)})),
qw AS (SELECT w.term, w.weight AS qweight, q.qid FROM w JOIN q ON w.id = q.qid),
sc AS (SELECT w.id AS id2, sum(w.weight * qw.qweight) AS score FROM w JOIN qw ON w.term = qw.term
       WHERE w.id <> qw.qid GROUP BY w.id),
r AS (SELECT id2, score, row_number() OVER (ORDER BY round(score, 9) DESC, id2) AS rank FROM sc)
SELECT r.id2, p.name, CAST(r.rank AS INTEGER) AS rank, round(r.score, 6) AS score
FROM r JOIN products p ON p.id = r.id2 WHERE r.rank <= {Q.TFIDF_TOP}"""
    o["product_export"] = f"""
WITH {PRODUCTS.strip()}
SELECT id AS product_id, name, p_retailprice AS price, p_retailprice AS original_price, sold AS all_time_quantity_sold,
       avg_star AS rating_average, n_lines AS review_count, CAST(p_size AS BIGINT) AS favourite_count,
       CAST(NULL AS BIGINT) AS day_ago_created, coalesce({clean_base('description')}, '') AS description,
       s_suppkey AS store_id, s_acctbal > 0 AS is_best_store,
       s_name AS seller_name, p_retailprice AS seller_price,
       TRY_CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) AS brand_id, p_brand AS brand_name,
       CAST(n_nationkey AS BIGINT) AS category_id, n_name AS category_name,
       CAST(r_regionkey AS BIGINT) AS category_parent_id, r_name AS category_parent_name, true AS is_leaf
FROM products"""
    o["product_slim"] = f"""
WITH {PRODUCTS.strip()}
SELECT id, name, r_name AS category, avg_star AS rating_average,
       coalesce({clean_base('description')}, '') AS description, s_name AS seller FROM products"""
    o["category_rollup"] = f"""
WITH {PRODUCTS.strip()}
SELECT r_name AS category_parent_name, n_name AS category_name, p_brand AS brand_name,
       CAST(grouping_id(r_name, n_name, p_brand) AS BIGINT) AS level, count(*) AS n_products,
       round(avg(p_retailprice), 6) AS avg_price, CAST(sum(sold) AS BIGINT) AS total_sold
FROM products GROUP BY ROLLUP (r_name, n_name, p_brand)"""
    o["price_changes"] = """
WITH r AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS time, l_partkey AS id, l_quantity AS quantity,
                  l_extendedprice AS price, l_orderkey, l_linenumber, l_linestatus FROM lineitem),
b1 AS (SELECT * FROM r WHERE l_linestatus = 'O'
       QUALIFY row_number() OVER (PARTITION BY time, id ORDER BY l_orderkey DESC, l_linenumber DESC) = 1),
b2 AS (SELECT * FROM r WHERE l_linestatus = 'F'
       QUALIFY row_number() OVER (PARTITION BY time, id ORDER BY l_orderkey DESC, l_linenumber DESC) = 1),
m AS (SELECT coalesce(b2.time, b1.time) AS time, coalesce(b2.id, b1.id) AS id,
             coalesce(b2.quantity, b1.quantity) AS quantity, coalesce(b2.price, b1.price) AS price
      FROM b1 FULL OUTER JOIN b2 ON b1.time = b2.time AND b1.id = b2.id)
SELECT id, time, price, quantity, price - lag(price) OVER (PARTITION BY id ORDER BY time) AS price_change,
       quantity - lag(quantity) OVER (PARTITION BY id ORDER BY time) AS quantity_change FROM m"""
    o["description_match"] = f"SELECT doc_id FROM documents WHERE list_contains({TOKENS}, {lit(Q.MATCH_WORD)})"
    o["snapshot_latest"] = (o["daily_snapshot"].rsplit("SELECT concat_ws", 1)[0]
                            + "SELECT id, time, concat_ws('_', time, CAST(id AS VARCHAR)) AS key, quantity, price FROM m "
                            + "QUALIFY row_number() OVER (PARTITION BY id ORDER BY time DESC) = 1")
    o["top_rated"] = f"""
WITH {PRODUCTS.strip()}
SELECT id, name, avg_star AS rating_average FROM products WHERE avg_star IS NOT NULL
ORDER BY round(avg_star, 9) DESC, id LIMIT {Q.TFIDF_TOP}"""
    return {k: v.strip() for k, v in o.items()}
