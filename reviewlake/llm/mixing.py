"""Mixing sources to target weights by temperature.

A source's share of all tokens, raised to an exponent between 0 and 1 and normalised, is its
weight: 1 keeps the shares, 0 makes all sources equal. The exponent is the largest one whose
weights reach the target entropy (as a part of the entropy of equal weights). If the budget
would then repeat a source more than ``max_repeats`` times, it is the smallest exponent
that keeps within that limit. It is found by repeated section: one aggregate over the
source table tries ``1 + 2**BITS`` exponents at once, which is BITS steps of bisection.

The budget defaults to the fewest tokens that let each source through at least once, so that
mixing loses no document. A source's documents are dealt into blocks; its budget is realised as
whole passes over all blocks and a last pass over the first blocks of a permutation (drawn anew for
each pass), as many as the budget covers. Hence each document of a chosen block is emitted once more.

Sources, blocks and weights are tables; no list of sources is gathered by the driver. The block
table has at most MAX_BLOCKS + LEAST_BLOCKS * (number of sources) rows: every source has LEAST_BLOCKS blocks
at least, so that a small one meets its weight by a part of its documents; ``realised`` reports how closely.

Defined results: a null source is a source of its own; a null or empty text has no tokens (its
document takes part with its block); a source without tokens has weight 0 and goes through
once. Repeated rows are rows of their own. Empty table: empty result. Extra columns are kept by
``mix_rows``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage

TARGET_ENTROPY = 0.97
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 1 << 16
LEAST_BLOCKS = 64
BITS = 5
STEPS = 5
SEED = 20


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def _sections(low: float, high: float) -> list[float]:
    return [low + (high - low) * i / (1 << BITS) for i in range((1 << BITS) + 1)]


def _try(sources: DataFrame, exponents: list[float], total: int) -> list:
    """Entropy and repeats at each exponent, over the whole table of sources."""
    p = F.col("tokens") / F.lit(float(total))
    power = F.pow(p, F.col("a"))
    return (sources.where("tokens > 0").withColumn("a", F.explode(F.array(*[F.lit(a) for a in exponents])))
            .groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln(p)).alias("l"),
                              F.count(F.lit(1)).alias("n"), F.max(power / p).alias("most"), F.min(power / p).alias("least"))
            .select("a", (F.ln("z") - F.col("a") * F.col("l") / F.col("z")).alias("entropy"), "n",
                    (F.col("most") / F.col("least")).alias("repeats"), "z", "least").orderBy("a").collect())


def exponent(sources: DataFrame, total: int, target_entropy: float = TARGET_ENTROPY,
             max_repeats: float = MAX_REPEATS) -> float:
    """The exponent that meets the target; entropy and repeats both fall as it grows."""
    def largest(holds) -> float:
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            rows = _try(sources, _sections(low, high), total)
            if not rows:
                return 1.0
            good = [r.a for r in rows if holds(r)]
            if len(good) == len(rows):
                return high
            if not good:
                return low
            low, high = good[-1], min(r.a for r in rows if r.a > good[-1])
        return low

    def smallest(holds) -> float:
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            rows = _try(sources, _sections(low, high), total)
            bad = [r.a for r in rows if not holds(r)]
            if not bad:
                return low
            low, high = bad[-1], min((r.a for r in rows if r.a > bad[-1]), default=1.0)
        return high

    a = largest(lambda r: r.entropy >= target_entropy * math.log(r.n) - 1e-9)
    within = lambda r: r.repeats <= max_repeats + 1e-9
    return round(a if all(map(within, _try(sources, [a], total))) else smallest(within), 6)


def _fraction(*parts: Column) -> Column:
    """A number in [0, 1) drawn by the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def plan(counts: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
         budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """(source, block, n_blocks, weight, copies, last_place) of each block, from (doc_id, source, n_tokens).

    copies: how often the block is emitted; last_place: its place in the last, partial pass.
    """
    sources = cut_lineage(counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    a = exponent(sources, total, target_entropy, max_repeats) if total else 1.0
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    power = F.when(F.col("tokens") > 0, F.pow(p, F.lit(a))).otherwise(0.0)
    sums = sources.agg(F.sum(power).alias("z"), F.min(F.when(F.col("tokens") > 0, power / p)).alias("least")).first()
    z, least = sums.z or 1.0, sums.least or 1.0
    tokens = float(budget) if budget else max(total, 1) * z / least
    size = max(block_tokens, -(-total // MAX_BLOCKS), 1)
    sources = sources.select(
        "source", "tokens", (power / F.lit(z)).alias("weight"),
        F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("tokens") / F.lit(size))).cast("int").alias("n_blocks"),
        (F.when(F.col("tokens") > 0, F.lit(tokens) * power / F.lit(z) / F.col("tokens")).otherwise(1.0)).alias("passes"))
    sources = cut_lineage(sources, "mix-weights")
    whole = F.floor(F.col("passes") + F.lit(1e-9))
    blocks = (sources.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
              .withColumn("drawn", F.struct(F.xxhash64(F.lit(seed), whole, "source", "block").alias("h"), F.col("block"))))
    places = (blocks.groupBy("source").agg(F.sort_array(F.collect_list("drawn")).alias("order"))
              .select("source", F.posexplode("order").alias("place", "d")).select(
                  "source", "place", F.col("d.block").alias("block")))
    same = F.col("b.source").eqNullSafe(F.col("o.source")) & (F.col("b.block") == F.col("o.block"))
    chosen = F.round((F.col("passes") - whole) * F.col("n_blocks"))
    return (blocks.alias("b").join(places.alias("o"), same)
            .select("b.source", "b.block", "n_blocks", "weight",
                    (whole + (F.col("place") < chosen).cast("int")).cast("int").alias("copies"),
                    F.col("place").alias("last_place")))


def _emit(rows: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """Join (source, doc_id, ...) rows with their block and emit each copy: pass, block and schedule."""
    sizes = blocks.groupBy("source").agg(F.first("n_blocks").alias("n"))
    dealt = (rows.join(sizes.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .withColumn("dealt", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("n")).cast("int")).drop("s", "n"))
    table = blocks.withColumnRenamed("source", "s")       # at most MAX_BLOCKS + LEAST_BLOCKS * number of sources rows
    return (dealt.join(table, F.col("source").eqNullSafe(F.col("s")) & (F.col("dealt") == F.col("block")))
            .drop("s", "dealt").where("copies > 0")
            .withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("schedule", (F.col("pass") - 1) + _fraction(F.lit(seed), "pass", "source", "block")))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       n_words(F.col("text").cast("string")).cast("long").alias("n_tokens"))


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """One row per emitted document: (doc_id, source, n_tokens, weight, pass, block, schedule).

    Reading the rows by schedule gives the permuted blocks of all sources, evenly mixed.
    """
    counts = cut_lineage(_narrow(docs), "mix-counts")
    blocks = cut_lineage(plan(counts, seed=seed, **how), "mix-blocks")
    return _emit(counts, blocks, seed).select("doc_id", "source", "n_tokens", "weight", "pass", "block", "schedule")


def realised(mixed: DataFrame) -> DataFrame:
    """(source, weight, realised) of the rows of ``mix``: target weight and part of all emitted tokens."""
    sums = mixed.groupBy("source").agg(F.first("weight").alias("weight"), F.sum("n_tokens").alias("t"))
    total = mixed.agg(F.sum("n_tokens").alias("all"))
    return sums.crossJoin(F.broadcast(total)).select("source", "weight", F.coalesce(F.try_divide("t", "all"), F.lit(0.0)).alias("realised"))


def mix_rows(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mixture emits it."""
    counts = cut_lineage(_narrow(docs), "mix-counts")
    blocks = cut_lineage(plan(counts, seed=seed, **how), "mix-blocks")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    return _emit(whole, blocks, seed).select("row.*")
