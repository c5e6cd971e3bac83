"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Asymmetric q-chunks. Of two near words let x be the shorter (L code points; the smaller of equally
long ones) and y the other (m is L or L + 1). x contributes two disjoint chunks of q = L // 2 code
points, its first and its last; y contributes its positional q-grams. One edit spoils at most one of
two disjoint chunks, and it moves the other by at most one position, so near words share a chunk and
a gram no further than one position apart. Words meet on (L, which chunk, letters) and every meeting is
verified. Grams that lie further than one position from both chunks can't meet, and aren't written.

A chunk that very many words share (a common prefix or ending) would make as many meetings as
pairs. Where chunks and grams of a key make more than ``PAIRS_OF_A_KEY`` pairs, its words meet by the
same rule on what is left of them: near words that share a chunk are near in the rest, so the
rest's two chunks (and grams) join the key. Each round halves the rest. With one code point left the words
of a key differ in that one alone, so their number is bounded by the alphabet. No pair is
dropped and none is made of all words of a large key.

A word's form is the near word with the largest count, if it is frequent enough; the root follows
forms to the last, by pointer doubling (counts double along the way, so there are few rounds).

Defined results: null texts have no words; a null doc_id counts as one without digits. Every row
counts, also rows that repeat. Ties go to the smallest word in code-point order. An
empty table gives no rows. Extra columns are ignored. A very long run of letters is one word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage

#: A maximal run of these is a word of the text.
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, MIN_RATIO = 5, 3, 2
#: A run whose hash this divides loses a code point.
TYPO_EVERY = 97
PAIRS_OF_A_KEY = 1 << 12


def _lowered(run: Column) -> Column:
    """A-Z in lower case; the quick way where all letters are of one byte."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo_every: int = TYPO_EVERY) -> DataFrame:
    """word, n: distinct words of all texts with their occurrences, some with a code point taken out by a rule.

    Words are counted inside each task before they are shuffled, so a word of any frequency is one row a task.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= min_length).select("doc", _lowered(F.col("run")).alias("run"))
    run, h = F.col("run"), F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (h % F.length(run)).cast("int")
    word = F.when(h % typo_every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)
    found = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _chunks(rows: DataFrame) -> DataFrame:
    """Two disjoint chunks of each row's rest, the keys they go by, and what is left without them."""
    return rows.selectExpr("key AS of", "word", "rest", "char_length(rest) AS l").selectExpr(
        "*", "inline(array(struct(0 AS c, 1 AS at), struct(1 AS c, l - l div 2 + 1 AS at)))").selectExpr(
        "xxhash64(of, l, c, substring(rest, at, l div 2)) AS key", "word",
        "concat(substring(rest, 1, at - 1), substring(rest, at + l div 2)) AS rest", "true AS chunk", "true AS aligned",
        "int(l - l div 2) AS l")


def _grams(rows: DataFrame) -> DataFrame:
    """Positional grams for chunks of rests of ``l`` code points, no further than one position from a chunk.

    ``aligned``: exactly where a chunk lies if the one edit is outside of it. Only these are followed further.
    """
    return rows.selectExpr("key AS of", "word", "rest", "l", "char_length(rest) AS m").selectExpr(
        "*", "inline(array(struct(0 AS c, 0 AS place), struct(1 AS c, l - l div 2 AS place)))").selectExpr(
        "*", "explode(filter(array(place - 1, place, place + 1), p -> p >= 0 AND p <= m - l div 2)) AS at").selectExpr(
        "xxhash64(of, l, c, substring(rest, at + 1, l div 2)) AS key", "word",
        "concat(substring(rest, 1, at), substring(rest, at + 1 + l div 2)) AS rest", "false AS chunk",
        "at = IF(c = 0, 0, m - l div 2) AS aligned", "int(l - l div 2) AS l")


def _meetings(signatures: DataFrame) -> DataFrame:
    """Verified pairs (a, b) of words that share a key; a is shorter, or smaller if equally long."""
    a = signatures.where("chunk").select("key", F.col("word").alias("a"))
    b = signatures.where("NOT chunk").select("key", F.col("word").alias("b"))
    la, lb = F.length("a"), F.length("b")
    ordered = (la < lb) | ((la == lb) & (F.col("a") < F.col("b")))
    return a.join(b, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")


def near_pairs(vocabulary: DataFrame, min_length: int = MIN_LENGTH, pairs_of_a_key: int = PAIRS_OF_A_KEY) -> DataFrame:
    """Pairs (a, b) of different words, one edit apart, each pair once; ``vocabulary`` has distinct words."""
    base = vocabulary.select(F.lit(0).cast("long").alias("key"), "word", F.col("word").alias("rest"))
    chunk_side = base
    gram_side = base.selectExpr("*", "explode(array(char_length(word) - 1, char_length(word))) AS l").where(F.col("l") >= min_length)
    found, number = [], 0
    while True:
        number += 1
        signatures = cut_lineage(_chunks(chunk_side).unionByName(_grams(gram_side)), f"signatures{number}")
        hot = signatures.groupBy("key").agg(F.sum(F.col("chunk").cast("long")).alias("x"), F.sum((~F.col("chunk")).cast("long")).alias("y"),
                                            F.max("l").alias("l"))
        hot = cut_lineage(hot.where((F.col("x") * F.col("y") > pairs_of_a_key) & (F.col("l") > 1)).select("key"), f"hot{number}")
        if hot.isEmpty():
            found.append(cut_lineage(_meetings(signatures), f"near{number}"))
            break
        found.append(cut_lineage(_meetings(signatures.join(hot, "key", "left_anti")), f"near{number}"))
        left = signatures.where("aligned").join(hot, "key", "left_semi").distinct()
        chunk_side, gram_side = left.where("chunk"), left.where("NOT chunk")
    return reduce(DataFrame.unionByName, found).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for the words (word, form) that have a form: pointers are doubled until all are at their last."""
    last = cut_lineage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while not last.where("open").isEmpty():
        onward = last.select(F.col("word").alias("root"), F.col("root").alias("further"))
        last = cut_lineage(last.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")), "roots")
    return last.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, min_ratio: int = MIN_RATIO,
             typo_every: int = TYPO_EVERY, pairs_of_a_key: int = PAIRS_OF_A_KEY) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = cut_lineage(words(docs, min_length, min_count, typo_every), "words")
    pairs = cut_lineage(near_pairs(vocabulary, min_length, pairs_of_a_key), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    counts = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
    frequent = -F.col("best.rank") >= min_ratio * F.col("n")
    known = cut_lineage(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best.other")).alias("form"),
        F.when(frequent, -F.col("best.rank")).alias("form_n")), "forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
