"""The n rows with the largest sparse dot product, for a table of query rows.

Rows are postings ``(id, term, weight)`` with weights of at least 0 (as tf-idf has). There are two exact ways.

Where few pairs of rows can be among the n best, a join by term, pruned per query by upper bounds:

1. every term keeps its largest weight and its ``champions``, the few rows where it weighs most;
2. the n-th best of a query's scores over champions alone is a lower bound of its real n-th best score;
3. a query's terms are ordered by the most they can add (own weight times the term's largest weight); the
   first of them, as long as their sum stays below that bound, can't lift a row into the n best by
   themselves. Their postings, which are the long ones of common terms, are not read as candidates;
4. rows that hold one of the other terms are candidates. Those whose score so far, with all that the passed-over
   terms could add, stays below the bound are dropped; the rest get the passed-over terms' part by a
   join on (id, term).

So a row that belongs to the n best is never lost. Postings of a term with more than ``PART_ROWS`` rows are
dealt into parts by the hash of their id, and the query's side is repeated for each part, so no term is one task's work.

Where the join would write more pairs than ``PAIRS_PER_POSTING`` for each posting, rows of equal terms and weights are one class
first, as they score alike: only the n + 1 smallest ids of a class can be among the n best of a row. Classes that are asked for and
classes are dealt into the blocks of a grid by the hash of their id. For every pair of blocks one task holds the postings of a block of
classes by term. Of a query it adds up its shortest lists until the longer ones can't lift a new class into the n + 1 best
of the block; these are then looked up for the classes that can still get there. No pair is shuffled, and only the n + 1 best of a
block leave the task. Blocks are made so that their postings fit a task (``BLOCK_POSTINGS``) and are otherwise a fixed number, so
what is shuffled grows with the postings, whatever terms rows share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.operators import term_blocks
from reviewlake.operators.topk import RANK_DIGITS
from reviewlake.session import cut_lineage, ship_package

PART_ROWS = 100_000
#: Champions that a term keeps for each row asked for.
CHAMPIONS = 4
#: Scores are ranked after rounding; bounds leave this much to spare, and this share of themselves.
SLACK, SLACK_SHARE = 1e-8, 1e-9
#: Pairs that the join may write for each posting, and those that it always may.
PAIRS_PER_POSTING, FEW_PAIRS = 2, 1_000_000
#: Postings of a block of rows, and of a block of queries, that a task holds; those under which a block is not cut.
BLOCK_POSTINGS, SMALL_POSTINGS = 1 << 22, 20_000
#: Blocks of queries, and pairs of blocks, that the work is dealt into when memory asks for no more.
GRID_QUERIES, GRID = 16, 48


def _by_row(ids: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings by id and term; those that repeat both are added up."""
    order = np.lexsort((terms, ids))
    ids, terms, weights = ids[order], terms[order], weights[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (terms[1:] != terms[:-1])
    start = np.flatnonzero(new)
    return ids[start], terms[start], np.add.reduceat(weights, start) if len(start) else weights


def _nth(scores: np.ndarray, n: int) -> float:
    return np.partition(scores, len(scores) - n)[len(scores) - n] if len(scores) >= n else -np.inf


def _best_rows(row: np.ndarray, vw: np.ndarray, lists: list[tuple], n: int, scores: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows among which the n best are, and their scores. ``lists``: (first and last posting, weight, most it adds).
    ``scores`` and ``seen`` have a zero for each row, and have it again at the end."""
    lists = sorted(lists, key=lambda x: x[1] - x[0])
    rest = np.append(np.cumsum([x[3] for x in lists][::-1])[::-1], 0.0)
    parts, done, read, many, nth = [], 0, 0, False, -np.inf
    while done < len(lists):
        most, first = max(4 * n, 2 * read), done
        while done < len(lists) and (done == first or read + lists[done][1] - lists[done][0] <= most):
            s, e, w, _ = lists[done]
            own = row[s:e]
            scores[own] += vw[s:e] * w                       # a row holds a term once
            if not many:
                new = own[~seen[own]]
                seen[new] = True
                parts.append(new)
            read, done = read + e - s, done + 1
            many = many or 2 * read > len(scores)
        found = np.flatnonzero(scores > SLACK) if many else np.concatenate(parts)
        nth = _nth(scores[found], n)
        if nth - 2 * SLACK > rest[done] * (1 + SLACK_SHARE):       # no other row can get there
            break
    if many and len(found) <= n:                             # those that score 0 are listed too
        found = np.unique(np.concatenate([row[s:e] for s, e, _, _ in lists]))
    held = scores[found]
    everywhere = slice(None) if many else found
    scores[everywhere], seen[everywhere] = 0.0, False
    scores = held
    for i in range(done, len(lists)):
        near = scores + rest[i] * (1 + SLACK_SHARE) >= nth - 2 * SLACK
        found, scores = found[near], scores[near]
        s, e, w, _ = lists[i]
        at = s + np.searchsorted(row[s:e], found)
        hit = at < e
        hit[hit] = row[at[hit]] == found[hit]
        scores[hit] += vw[at[hit]] * w
        nth = max(nth, _nth(scores, n))
    return found, scores


def block_best(q: tuple, v: tuple, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(id1, ids, scores) of every query row: the n best, itself included if it is there. ``q`` and ``v``: ids, numbered terms
    and weights of postings."""
    qi, qt, qw = _by_row(*q)
    vi, vt, vw = _by_row(*v)
    ids, row = np.unique(vi, return_inverse=True)
    order = np.argsort(vt, kind="stable")
    row, vt, vw = row[order], vt[order], vw[order]
    low, high = np.searchsorted(vt, qt), np.searchsorted(vt, qt, side="right")
    starts = np.flatnonzero(np.diff(vt, prepend=vt[:1] - 1)) if len(vt) else np.empty(0, dtype=np.int64)
    largest = np.append(np.maximum.reduceat(vw, starts) if len(starts) else np.empty(0), 0.0)
    most = qw * largest[np.searchsorted(starts, low)]
    first = np.flatnonzero(np.diff(qi, prepend=qi[:1] - 1)) if len(qi) else []
    zeros, seen = np.zeros(len(ids)), np.zeros(len(ids), dtype=bool)
    for a, b in zip(first, [*first[1:], len(qi)], strict=True):
        lists = [(int(low[i]), int(high[i]), qw[i], most[i]) for i in range(a, b) if low[i] < high[i]]
        if not lists:
            continue
        found, scores = _best_rows(row, vw, lists, n, zeros, seen)
        near = np.flatnonzero(scores >= _nth(scores, n) - SLACK)
        best = near[np.lexsort((ids[found[near]], -np.round(scores[near], RANK_DIGITS)))[:n]]
        yield int(qi[a]), ids[found[best]], scores[best]


def _block_task(n: int):
    def run(table: pa.Table) -> pa.Table:
        term = pa.chunked_array(table.column("term")).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        side = table.column("side").to_numpy()
        columns = table.column("id").to_numpy(), term, table.column("weight").to_numpy()
        found = list(block_best(*(tuple(c[side == i] for c in columns) for i in (0, 1)), n))
        id1 = np.repeat(np.array([x[0] for x in found], dtype=np.int64), [len(x[1]) for x in found])
        return pa.table({"id1": id1, "id2": np.concatenate([x[1] for x in found] or [np.empty(0, dtype=np.int64)]),
                         "score": np.concatenate([x[2] for x in found] or [np.empty(0)])})
    return run


def _dot() -> Column:
    return F.sum(F.col("weight") * F.col("qweight"))


def _rank(of: str) -> Window:
    return Window.partitionBy(of).orderBy(F.round("score", RANK_DIGITS).desc(), F.col("id2"))


def top_similar(weights: DataFrame | term_blocks.TermBlocks, id_col: str, n: int, queries: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """(id1, id2, score, rank): for every query row id1 the n other rows with the largest dot product.

    ``weights``: (id_col, term, weight), one row per id and term, weights >= 0. ``queries``: ids (id_col) of the rows
    to search for; all rows if not given. Ties go to the smaller id. Rows that share no term are not listed; a row that shares
    only terms of weight 0 has score 0 and is. Weights in blocks are searched block by block (``term_blocks``).
    """
    if isinstance(weights, term_blocks.TermBlocks):
        return term_blocks.top_similar(weights, n, queries, id_col)
    w = cut_lineage(weights.select(F.col(id_col).cast("long").alias("id"), "term", F.col("weight").cast("double").alias("weight")),
                    "postings")
    terms = w.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("weight").alias("most"))
    asked = w if queries is None else w.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    parts = F.ceil(F.col("df") / part_rows).cast("int").alias("parts")
    q = cut_lineage(asked.select(F.col("id").alias("id1"), "term", F.col("weight").alias("qweight")).join(
        terms.select("term", "df", "most", parts), "term"), "query-terms")
    champions = q.agg(F.sum(F.least(F.col("df"), F.lit(CHAMPIONS * n)))).first()[0]
    most_pairs = max(FEW_PAIRS, PAIRS_PER_POSTING * w.count())
    if (champions or 0) > most_pairs:
        return _blocked(w, q, n)

    # Lower bound of each query's n-th best score, from champions.
    best = Window.partitionBy("term").orderBy(F.col("weight").desc(), "id")
    champions = w.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CHAMPIONS * n).drop("place")
    seen = q.join(champions, "term").where("id <> id1").groupBy("id1", F.col("id").alias("id2")).agg(_dot().alias("score"))
    bound = (seen.withColumn("rank", F.row_number().over(_rank("id1"))).where(F.col("rank") == n)
             .select("id1", (F.col("score") * (1 - SLACK_SHARE) - SLACK).alias("bound")))

    # Terms that can lift a row over the bound, and the others.
    add = F.col("qweight") * F.col("most")
    order = Window.partitionBy("id1").orderBy(add, "term").rowsBetween(Window.unboundedPreceding, 0)
    split = q.join(bound, "id1", "left").withColumn("reach", F.sum(add).over(order))
    split = cut_lineage(split.withColumn("passed", F.coalesce(F.col("reach") < F.col("bound"), F.lit(False))), "query-terms-split")
    rest = split.where("passed").groupBy("id1").agg(F.max("reach").alias("more"), F.max("bound").alias("bound"))

    if (split.where("NOT passed").agg(F.sum("df")).first()[0] or 0) > most_pairs:
        return _blocked(w, q, n)
    lists = split.where("NOT passed").selectExpr("id1", "term", "qweight", "explode(sequence(0, parts - 1)) AS part")
    dealt = w.join(terms.select("term", parts), "term").select(
        "id", "term", "weight", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int").alias("part"))
    scores = (lists.join(dealt, ["term", "part"]).where("id <> id1").groupBy("id1", F.col("id").alias("id2"))
              .agg(_dot().alias("score")).join(rest, "id1", "left"))
    scores = cut_lineage(scores.where(f"more IS NULL OR score + more >= bound - {SLACK}").select("id1", "id2", "score", "more"), "candidates")

    # What the passed-over terms add to the candidates that are left.
    full = (scores.where("more IS NOT NULL").select("id1", "id2").join(split.where("passed").select("id1", "term", "qweight"), "id1")
            .join(w.withColumnRenamed("id", "id2"), ["id2", "term"]).groupBy("id1", "id2").agg(_dot().alias("added")))
    out = scores.join(full, ["id1", "id2"], "left").select("id1", "id2", (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"))
    return out.withColumn("rank", F.row_number().over(_rank("id1"))).where(F.col("rank") <= n)


def _classes(w: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, cls) of every row, and the postings (id, term, weight) of one row of each class. Rows of a class have equal terms
    and weights (by 128 bits); its number is its smallest id."""
    vec = F.array_sort(F.collect_list(F.struct("term", "weight")))
    rows = w.where("id IS NOT NULL AND term IS NOT NULL").groupBy("id").agg(vec.alias("vec"))
    rows = cut_lineage(rows.select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")), "vectors")
    keys = rows.select("id", "h1", "h2")
    members = cut_lineage(keys.join(keys.groupBy("h1", "h2").agg(F.min("id").alias("cls")), ["h1", "h2"]).select("id", "cls"), "members")
    one = rows.join(members.where("id = cls").select("id"), "id", "left_semi")
    return members, cut_lineage(one.select("id", F.inline("vec")), "classes")


def _blocked(w: DataFrame, q: DataFrame, n: int) -> DataFrame:
    """The n best by classes and blocks. ``w``: postings, ``q``: those of the query rows (id1)."""
    ship_package(w.sparkSession)
    members, v = _classes(w)
    asked = members.join(q.select(F.col("id1").alias("id")).distinct(), "id", "left_semi")
    qv = cut_lineage(v.join(asked.select(F.col("cls").alias("id")).distinct(), "id", "left_semi"), "asked-classes")
    n_rows, n_asked = v.count(), qv.count()

    def blocks(postings: int, most: int) -> int:
        return max(1, min(most, -(-postings // SMALL_POSTINGS)), -(-postings // BLOCK_POSTINGS))
    bq = blocks(n_asked, max(1, round(GRID_QUERIES * (n_asked / max(1, n_rows)) ** 0.5)))      # few queries: the rows are copied less
    bv = blocks(n_rows, -(-GRID // bq))

    def side(df: DataFrame, which: int, own: int, other: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.lit(own).cast("long"))
        all_of = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long")))
        qb, vb = ((place, all_of), (all_of, place))[which]
        return df.select(F.lit(which).alias("side"), qb.alias("qb"), vb.alias("vb"), "id", "term", "weight")
    both = side(qv, 0, bq, bv).unionByName(side(v, 1, bv, bq))
    dealt = both.withColumn("grp", (F.col("qb") * F.lit(bv) + F.col("vb")).cast("int")).drop("qb", "vb").repartitionById(bq * bv, "grp")
    out = dealt.groupBy("grp").applyInArrow(_block_task(n + 1), "id1 long, id2 long, score double")
    out = out.withColumn("rank", F.row_number().over(_rank("id1"))).where(F.col("rank") <= n + 1)
    return _members_best(out.select(F.col("id1").alias("cls"), F.col("id2").alias("other"), "score"), members, asked, n)


def _members_best(best: DataFrame, members: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    """The n best rows of every row asked for, from the n + 1 best classes of its class, (cls, other, score)."""
    by_id = Window.partitionBy("cls").orderBy("id")
    first = (members.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= n + 1)
             .select(F.col("cls").alias("other"), F.col("id").alias("id2")))
    rows = best.join(first, "other").withColumn("rank", F.row_number().over(_rank("cls"))).where(F.col("rank") <= n + 1)
    lists = rows.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("rank", "id2", "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda x: x["id2"] != F.col("id1")), 1, n)
    return (asked.withColumnRenamed("id", "id1").join(lists, "cls").select("id1", F.posexplode(others).alias("at", "row"))
            .select("id1", "row.id2", "row.score", (F.col("at") + 1).alias("rank")))
