"""Joins (J1-J7) and the broadcast policy.

Policy: an explicit broadcast hint is given only after a bounded measurement of rows and bytes proves
the side small (it reads at most n+1 rows) and only where that side is cheap to count (a
materialised table or a handful of query rows). Everywhere else the join is left to Catalyst +
AQE: both sides are shuffled on the key, and AQE switches to a broadcast at runtime from the
measured shuffle size (a size check that costs no extra job); skewed partitions are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when ``df`` has at most ``max_rows`` rows and its values, written out, hold at
    most ``max_bytes`` (both measured over at most ``max_rows`` + 1 rows)."""
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.to_json(F.struct(
        *[F.col(f"`{c}`") for c in df.columns])))).alias("bytes")).first()
    return F.broadcast(df) if size.rows <= max_rows and (size.bytes or 0) <= max_bytes else df


def enrich_name(df: DataFrame, products: DataFrame, key: str = "product_id",
                name_col: str = "name_product") -> DataFrame:
    """Left outer lookup of the product name; missing -> NULL. Duplicate product keys are
    reduced to one (largest name) first so the join cannot multiply rows. The catalogue can be
    large, so the strategy is AQE's (runtime broadcast when the names turn out small)."""
    names = products.groupBy(key).agg(F.max(name_col).alias(name_col))
    return df.join(names, on=key, how="left")


def dictionary_join(df: DataFrame, dict_df: DataFrame, key: str, value: str, order_col: str,
                    out_col: str, default: str = "") -> DataFrame:
    """Text-id dictionary; the last duplicate (largest ``order_col``) wins; missing -> default."""
    d = dict_df.groupBy(key).agg(F.max_by(value, order_col).alias(out_col))
    return (df.join(d, on=key, how="left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(default))))


def attach_names(sim: DataFrame, products: DataFrame, sim_key: str = "id2", key: str = "id",
                 cols: Sequence[str] = ("name",)) -> DataFrame:
    """Inner equi-join of result rows to product rows by id (never by position)."""
    p = products.select(F.col(key).alias(sim_key), *cols)
    return sim.join(p, on=sim_key, how="inner")




def anti(df: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(done, on=key, how="left_anti")


def not_yet_sent(df: DataFrame, history: DataFrame, keys: Sequence[str] = ("id", "name")) -> DataFrame:
    """(id, name) pairs not in the history, each once."""
    keys = list(keys)
    return df.select(*keys).dropDuplicates(keys).join(history.select(*keys), on=keys, how="left_anti")
