"""Seeded random back-fill (V10): the reference picks a random row, writes a random integer into it, and does so a
given number of times, so a row may be drawn again and its last number stays.

Here draw i takes the row at position ``hash(i) mod n`` and the number ``lo + hash'(i) mod (hi - lo + 1)``, exactly ``draws``
times. Rows have their position by key: a range partitioning, the number of rows of each partition, and the
place inside it; no single task sorts or numbers the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage


def hit_fraction(draws: int, rows: int) -> float:
    """Expected share of rows that ``draws`` uniform draws with replacement hit."""
    return 1.0 - (1.0 - 1.0 / rows) ** draws if rows > 0 else 0.0


def positions(df: DataFrame, key: str) -> DataFrame:
    """(key, position): rows numbered from 0 in the order of their key, across partitions."""
    rows = df.select(F.col(key).alias("key")).orderBy("key").select(
        "key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    rows = cut_lineage(rows, "positions")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))                        # one row per partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").select(
        F.col("key").alias(key), (F.col("before") + F.col("at")).alias("position"))


def draw(i: Column, seed: int, n: Column) -> Column:
    """A number from 0 to n - 1 that depends on the draw and the seed alone."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), i.cast("string")).cast("binary"), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), n)


def random_backfill(df: DataFrame, key: str, col: str, lo: int, hi: int, draws: int, seed: int = 42) -> DataFrame:
    """Write a uniform integer in [lo, hi] into ``col`` of a row drawn with replacement, ``draws`` times; of several
    draws of a row the last stays. ``key`` is unique. An empty table stays empty."""
    rows = df.select(F.count(F.lit(1)).alias("rows"))
    drawn = df.sparkSession.range(draws).join(F.broadcast(rows)).where("rows > 0").select(
        F.col("id").alias("i"), draw(F.col("id"), seed, F.col("rows")).alias("position"),
        (F.lit(lo) + draw(F.col("id"), seed + 1, F.lit(hi - lo + 1))).alias("number"))
    last = drawn.groupBy("position").agg(F.max_by("number", "i").alias("number"))
    hit = positions(df, key).join(last, "position").select(key, F.col("number").alias("_number"))
    value = F.coalesce(F.col("_number").cast(df.schema[col].dataType), F.col(col)).alias(col)
    return df.join(hit, key, "left").select(*[value if c == col else F.col(c) for c in df.columns])
