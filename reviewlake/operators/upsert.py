"""Keyed upserts and daily snapshots (K1, K2, K6, K7) without a table format.

Semantics: a put overwrites only the cells it carries; cells it lacks (NULL) keep their old value;
new keys are inserted. Within one batch, puts to the same key apply in ``order``: per column the
last non-null value wins. Merging is idempotent: merge(merge(t, u), u) == merge(t, u).

Storage (``KeyedTable``): versioned Parquet partitions and manifests, see there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.session import cut_lineage, delete_folder, list_folder


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def combine_puts(updates: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """Collapse several puts per key into one: per column, the last non-null value by ``order``."""
    keys = _keys(key)
    ordering = F.struct(*[F.col(o) for o in order])
    vals = [c for c in updates.columns if c not in keys and c not in order]
    return updates.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in vals])


def merge_upsert(target: DataFrame, updates: DataFrame, key, order: Sequence[str] | None = None) -> DataFrame:
    """K2: column-level upsert of ``updates`` into ``target`` (full outer join on the key)."""
    keys = _keys(key)
    u = combine_puts(updates, keys, order) if order else updates
    t_cols = [c for c in target.columns if c not in keys]
    u_cols = set(u.columns) - set(keys)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in t_cols])
    uu = u.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in u_cols])
    j = t.join(uu, on=keys, how="full_outer")
    out = [F.coalesce(F.col(f"_u_{c}"), F.col(f"_t_{c}")).alias(c) if c in u_cols else F.col(f"_t_{c}").alias(c)
           for c in t_cols]
    extra = [F.col(f"_u_{c}").alias(c) for c in sorted(u_cols - set(t_cols))]
    return j.select(*keys, *out, *extra)


def replace_latest(target: DataFrame | None, updates: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """K7: whole-document replace by id, last write wins (documents absent from ``updates`` stay)."""
    keys = _keys(key)
    ordering = F.struct(*[F.col(o) for o in order])
    vals = [c for c in updates.columns if c not in keys]
    last = (updates.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(v) for v in vals]), ordering).alias("_r"))
            .select(*keys, *[F.col(f"_r.{v}").alias(v) for v in vals]))
    if target is None:
        return last
    return target.join(last.select(*keys), on=keys, how="left_anti").unionByName(last, allowMissingColumns=True)


def snapshot_merge(snapshot: DataFrame | None, batch: DataFrame, order: Sequence[str],
                   date_col: str = "time", id_col: str = "id", key_col: str = "key") -> DataFrame:
    """K6: daily snapshot, one row per (date, id) keyed ``{date}_{id}``; a re-run of the same day
    updates its rows in place (column-level, as K2)."""
    keys = [date_col, id_col]
    rows = combine_puts(batch, keys, order)
    merged = rows if snapshot is None else merge_upsert(snapshot.drop(key_col), rows, keys)
    return merged.withColumn(key_col, F.concat_ws("_", F.col(date_col).cast("string"), F.col(id_col).cast("string")))


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """K1: create an empty table only when none exists (``mode('ignore')``)."""
    w = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class KeyedTable:
    """K2 / K6 storage: partitioned Parquet in versions, with a manifest as the only commit point.

    A batch is reduced to one row per key and written once, to a new version folder. The manifest of that
    version then names, for every partition, the versions that hold its rows, the table's schema, and the last batch of
    each query. Readers take the newest complete manifest, so they see a batch wholly or not at all. Partitions
    are hash buckets of the key, or the text of ``partition_col``; the key columns keep their own type.

    A batch that is small beside the rows of a partition is laid over them as one more layer, so it writes its own rows only;
    layers are merged by key when they are read. Once the layers above the first hold ``MERGE_SHARE`` of its rows, or
    there are ``MAX_LAYERS``, the batch that comes then writes the partition anew in one layer. Rows are written in files of
    about ``file_rows`` rows by the hash of their key, so a large partition (one day, say) is the work of many tasks.

    A table has one writer at a time; two that commit the same version are told by the manifest's folder, which the
    second finds in place unless both looked at the same moment.
    """

    KEPT_VERSIONS = 3
    MAX_LAYERS, MERGE_SHARE = 8, 0.25

    def __init__(self, spark: SparkSession, path: str, key, buckets: int = 64, partition_col: str | None = None,
                 file_rows: int = 100_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = _keys(key)
        self.buckets = buckets
        self.partition_col = partition_col
        self.file_rows = file_rows

    def _manifest(self) -> dict | None:
        """The newest manifest whose write was completed."""
        for name in sorted(list_folder(self.spark, f"{self.path}/manifests"), reverse=True):
            folder = f"{self.path}/manifests/{name}"
            if "_SUCCESS" in list_folder(self.spark, folder):
                return json.loads(self.spark.read.schema("value string").text(folder).first()["value"])
        return None

    def _part(self) -> Column:
        if self.partition_col:
            return F.regexp_replace(F.coalesce(F.col(self.partition_col).cast("string"), F.lit("none")), "[^0-9A-Za-z-]", "_")
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")

    def _stored(self, manifest: dict, parts: Sequence[str]) -> DataFrame:
        """Rows of all layers of the partitions, with the version of their layer."""
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/data/{v}/_part={p}" for p in sorted(parts) for v, _ in manifest["parts"][p]["layers"]]
        if not folders:
            return self.spark.createDataFrame([], schema.add("_layer", T.LongType()))
        layer = F.regexp_extract(F.col("_metadata.file_path"), r"/data/v(\d+)-", 1).cast("long")
        return self.spark.read.schema(schema).parquet(*folders).select("*", layer.alias("_layer"))

    def _resolved(self, layered: DataFrame, mode: dict) -> DataFrame:
        """One row per key: whole rows by their version columns and then their layer, or the last non-null value by layer."""
        if mode["whole"]:
            return replace_latest(None, layered, self.keys, [*mode["order"], "_layer"]).drop("_layer")
        return combine_puts(layered, self.keys, ["_layer"])

    def _rows(self, manifest: dict, parts: Sequence[str]) -> DataFrame:
        """Rows of the partitions: those of a single layer as they lie, others merged."""
        one = [p for p in parts if len(manifest["parts"][p]["layers"]) == 1]
        out = self._stored(manifest, one).drop("_layer")
        modes = {json.dumps(manifest["parts"][p]["mode"]) for p in parts if p not in set(one)}
        for mode in sorted(modes):
            some = [p for p in parts if p not in set(one) and json.dumps(manifest["parts"][p]["mode"]) == mode]
            out = out.unionByName(self._resolved(self._stored(manifest, some), json.loads(mode)))
        return out

    def read(self) -> DataFrame | None:
        manifest = self._manifest()
        return None if manifest is None else self._rows(manifest, list(manifest["parts"]))

    def _write(self, rows: DataFrame, sizes: dict[str, int], version: str) -> None:
        """Rows (with _part) into the version's folders; a partition of n rows in about n / file_rows files."""
        files = {p: max(1, -(-n // self.file_rows)) for p, n in sizes.items()}
        large = self.spark.createDataFrame([(p, n) for p, n in files.items() if n > 1], "_part string, _files int")
        split = F.pmod(F.xxhash64(F.lit(17), *self.keys), F.coalesce("_files", F.lit(1)))
        rows = rows.join(F.broadcast(large), "_part", "left").withColumn("_split", split)      # at most a row for each partition
        rows = rows.repartition(sum(files.values()), "_part", "_split").drop("_files", "_split")
        rows.write.partitionBy("_part").parquet(f"{self.path}/data/{version}")

    def upsert(self, updates: DataFrame, order: Sequence[str] | None = None, batch_id=None, query: str = "",
               whole_row: bool = False, arrival: Sequence[str] = (), messages: DataFrame | None = None) -> None:
        """Apply one batch. Of several rows of a key the last by ``order`` (then ``arrival``) wins: whole, or
        per column its last non-null value.

        ``order`` columns are versions: they are stored with whole rows, and an older version never
        replaces a newer one. ``arrival`` columns (offset, file position) only order a batch and are not
        stored. A batch needs one of them. Rows with a null key are no documents and are refused.
        ``query`` names the writer of ``batch_id``: a batch that this writer has committed is skipped.
        ``messages`` (one text column) become visible with the rows of the batch, see ``messages``.
        """
        if not order and not arrival:
            raise ValueError("an upsert needs order or arrival columns to choose the last row of a key")
        manifest = self._manifest() or {"version": 0, "parts": {}, "schema": None, "batches": {}}
        if batch_id is not None and int(batch_id) <= manifest["batches"].get(query, -1):
            return
        by = [*(order or ()), *arrival]
        rows = updates.dropna(subset=self.keys)
        if whole_row:
            last = replace_latest(None, rows, self.keys, by).drop(*arrival)
        else:
            last = combine_puts(rows, self.keys, by)
        last = cut_lineage(last.withColumn("_part", self._part()), "upsert")      # one row per key
        fresh = {r["_part"]: r["n"] for r in last.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}   # partitions of the batch
        mode = {"whole": whole_row, "order": list(order or ()) if whole_row else []}
        number = manifest["version"] + 1
        outgoing = f"{self.path}/messages/{number:010d}"
        if messages is not None:
            messages.write.mode("overwrite").text(outgoing)         # in place of what a failed attempt left
        else:
            delete_folder(self.spark, outgoing)
        version = f"v{number:010d}-{uuid.uuid4().hex[:8]}"
        parts, schema = dict(manifest["parts"]), manifest["schema"]
        new = last.drop("_part")
        if schema is None:
            schema = new.schema.jsonValue()
        elif fresh:
            known = T.StructType.fromJson(schema)
            more = [f for f in new.schema.fields if f.name not in known.names]
            schema = T.StructType([*known.fields, *more]).jsonValue()
        merged, laid = [p for p in fresh if p in parts and self._merges(parts[p], fresh[p], mode)], dict(fresh)
        if merged:
            again = last.where(F.col("_part").isin(merged)).drop("_part").withColumn("_layer", F.lit(number).cast("long"))
            stored = self._rows({**manifest, "schema": schema}, merged).withColumn("_layer", F.lit(0).cast("long"))
            whole = self._resolved(stored.unionByName(again, allowMissingColumns=True), mode).withColumn("_part", self._part())
            last = last.where(~F.col("_part").isin(merged)).unionByName(whole, allowMissingColumns=True)
            laid |= {p: fresh[p] + sum(n for _, n in parts[p]["layers"]) for p in merged}
        if fresh:
            self._write(last, laid, version)
        for p, n in laid.items():
            below = parts[p]["layers"] if p in parts and p not in merged else []
            parts[p] = {"layers": [*below, [version, n]], "mode": mode}
        batches = manifest["batches"] if batch_id is None else {**manifest["batches"], query: int(batch_id)}
        self._commit({"version": number, "parts": parts, "schema": schema, "batches": batches})

    def _merges(self, part: dict, rows: int, mode: dict) -> bool:
        """Whether a batch with ``rows`` rows for the partition writes it anew."""
        (_, base), *over = part["layers"]
        return part["mode"] != mode or len(over) + 2 > self.MAX_LAYERS or rows + sum(n for _, n in over) > self.MERGE_SHARE * base

    def messages(self, after: int = 0) -> tuple[DataFrame, int]:
        """Committed messages (value) of the versions above ``after``, and the version to go on from.

        A folder of messages bears the number of its version and counts only once a manifest has that number, so
        what a failed batch left is never read."""
        manifest = self._manifest()
        last = manifest["version"] if manifest else 0
        folders = [f"{self.path}/messages/{n}" for n in sorted(list_folder(self.spark, f"{self.path}/messages")) if after < int(n) <= last]
        read = self.spark.read.schema("value string")
        return (read.text(folders) if folders else self.spark.createDataFrame([], "value string")), max(after, last)

    def _commit(self, manifest: dict) -> None:
        """Write the manifest (fails if this version has one) and drop what none refers to."""
        name = f"{manifest['version']:010d}"
        (self.spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
         .write.mode("error").text(f"{self.path}/manifests/{name}"))
        kept = sorted(list_folder(self.spark, f"{self.path}/manifests"))[-self.KEPT_VERSIONS:]
        for old in set(list_folder(self.spark, f"{self.path}/manifests")) - set(kept):
            delete_folder(self.spark, f"{self.path}/manifests/{old}")
        used: set[str] = set()
        for m in [manifest, *(json.loads(self.spark.read.schema("value string").text(f"{self.path}/manifests/{n}").first()["value"])
                              for n in kept[:-1])]:
            used |= {v for part in m["parts"].values() for v, _ in part["layers"]}
        for folder in list_folder(self.spark, f"{self.path}/data"):
            if folder not in used and int(folder[1:11]) < manifest["version"]:
                delete_folder(self.spark, f"{self.path}/data/{folder}")


def write_daily_snapshot(spark: SparkSession, path: str, batch: DataFrame, order: Sequence[str],
                         date_col: str = "time", id_col: str = "id", batch_id=None, query: str = "") -> None:
    """K6 writer: partitioned by day; only the days present in ``batch`` are rewritten."""
    t = KeyedTable(spark, path, [date_col, id_col], partition_col=date_col)
    key = F.concat_ws("_", F.col(date_col).cast("string"), F.col(id_col).cast("string"))
    t.upsert(batch.withColumn("key", key), order=order, batch_id=batch_id, query=query)


def product_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """K3: current product rows keyed by product id."""
    return KeyedTable(spark, path, "id", buckets)


def review_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """K4: review rows keyed by review id."""
    return KeyedTable(spark, path, "id", buckets)


def overview_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """K5: rating overview rows keyed by product id."""
    return KeyedTable(spark, path, "product_id", buckets)


def latest_view(snapshot: DataFrame, id_col: str = "id", date_col: str = "time") -> DataFrame:
    """The current row per id from the daily snapshot table (replaces the separate 'current
    product' table the old readers expected): ``max_by`` over the date, partial aggregation."""
    vals = [c for c in snapshot.columns if c != id_col]
    last = F.max_by(F.struct(*[F.col(v) for v in vals]), F.col(date_col)).alias("_r")
    return snapshot.groupBy(id_col).agg(last).select(id_col, *[F.col(f"_r.{v}").alias(v) for v in vals])
