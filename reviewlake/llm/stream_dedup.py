"""Exact deduplication of a stream of documents with disk-backed keyed state.

Texts are equal when they are identical after deleting every space, \t, \n, \v, \f and \r. A first
pass turns each document into a fingerprint (digest of the normalised text, stable identifier,
content locator) and lands the fingerprints as files of the shared folder. A Structured Streaming
query reads that feed in ``MICRO_BATCHES`` micro-batches or more, of ``BATCH_BYTES`` at most; its state store (RocksDB, no
watermark, no expiry) keeps, per digest, the count and the identifier and locator of the row that stays, so a
document meets those of all earlier batches in the state. Partial aggregation in each
task combines the rows of a hot digest before the shuffle, so the state gets one row per
digest and task.

A locator is a file and the number of the row in it. The texts of digests with hits are fetched by their
locators and compared in full with the text at the locator that the state kept; a locator that leads to no text of its
digest is an error. Texts that share a digest but not their bytes are grouped by the bytes themselves.
Documents that are not read from Parquet files are written to the shared folder first, so that they have locators.

Of equal texts, the row with the most code points in its original text stays, then the smallest
doc_id (null last), then the first row by locator. Null text counts as empty, and empty texts are equal. Rows
that repeat a doc_id are rows of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage, folder_bytes, scratch_path

#: Micro-batches that the feed makes at least, and most bytes of the feed in one of them.
MICRO_BATCHES, BATCH_BYTES = 3, 4 << 30
#: State on disk; many small stores, so no space is reserved ahead, and a batch uploads its changes only.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_LAST = (1 << 63) - 1


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _kept() -> Column:
    """The locator and id of the row that stays: most code points, smallest id (null last), smallest locator."""
    return F.min_by(F.struct("file", "row", "doc_id"), F.struct(
        (-F.col("n_points")).alias("n"), F.coalesce(F.col("doc_id"), F.lit(_LAST)).alias("i"), "file", "row"))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as the struct row, with the file and the number of the row in it that they were read from."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")
    try:
        return docs.select(own, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:                                     # not read from Parquet files
        landed = cut_lineage(docs.select(own), "dedup-documents")
        return landed.select("row_", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def marked(source: DataFrame, locators: DataFrame) -> DataFrame:
    """The rows of ``source`` whose locator is among the locators.

    The locators are written as one bit for each row, in a row for each 4,096 rows of a file: a table so small beside the texts
    that Spark can broadcast it, so that no text is shuffled to find its locator.
    """
    words = locators.groupBy("file", F.shiftright("row", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(row & 63))")).alias("bits"))
    marks = cut_lineage(words.groupBy("file", F.shiftright("word", 6).alias("block")).agg(       # 64 words at most
        F.map_from_entries(F.collect_list(F.struct(F.expr("word & 63"), "bits"))).alias("marks")), "dedup-marks")
    met = source.withColumn("block", F.shiftright("row", 12)).join(marks, ["file", "block"])
    return met.where(F.expr("bit_get(marks[shiftright(row, 6) & 63], int(row & 63)) = 1")).select(*source.columns)


def fingerprints(source: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(file, row, doc_id, digest, n_points) of each row, landed in the shared folder."""
    text = F.col("row_.text").cast("string")
    out = source.select("file", "row", F.col("row_.doc_id").cast("long").alias("doc_id"), digest(normalised(text)).alias("digest"),
                        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_points"))
    if source.rdd.getNumPartitions() < MICRO_BATCHES:             # a file is the least that a micro-batch reads
        out = out.repartition(MICRO_BATCHES)
    return cut_lineage(out, "fingerprints")


def keyed_state(feed: DataFrame) -> DataFrame:
    """The state per digest: how many rows, and the row that stays with its id and locator."""
    return feed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), _kept().alias("keep"))


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` and those of the state, so that the caller's stay as they are."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in _STATE.items():
        own.conf.set(name, value)
    return own


def run_stream(rows: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Run the landed fingerprints through the keyed state and return the last state of each digest."""
    spark, files = rows.sparkSession, rows.inputFiles()
    if not files:
        return keyed_state(rows)
    out, checkpoint = scratch_path(spark, "dedup-state"), scratch_path(spark, "dedup-checkpoint")
    folder = files[0].rsplit("/", 1)[0]
    size = folder_bytes(spark, folder)
    batch_bytes = batch_bytes or max(1, min(BATCH_BYTES, size // MICRO_BATCHES))
    feed = _own_session(spark).readStream.schema(rows.schema).option("maxBytesPerTrigger", batch_bytes).parquet(folder)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")        # a replay writes the same folder

    (keyed_state(feed).writeStream.outputMode("update").foreachBatch(land)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    states = spark.read.parquet(out)
    return (states.groupBy("digest").agg(F.max_by(F.struct("group_size", "keep"), "batch").alias("s"), F.count(F.lit(1)).alias("n_batches"))
            .select("digest", "s.group_size", "s.keep", "n_batches"))


def check_bytes(source: DataFrame, rows: DataFrame, states: DataFrame) -> bool:
    """Whether all members of every digest have the bytes of the text at the locator that the state kept."""
    hits = states.where("group_size > 1").select("digest", F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"))
    wanted = cut_lineage(rows.select("file", "row", "digest").join(hits, "digest"), "dedup-wanted")
    # Only the texts of hits are shuffled and written.
    member = cut_lineage(marked(source, wanted).select("file", "row", normalised(F.col("row_.text").cast("string")).alias("content")).join(
        wanted, ["file", "row"]), "dedup-hits")
    kept = member.where("file = keep_file AND row = keep_row").select("digest", F.col("content").alias("kept_content"))
    found = member.join(kept, "digest", "left").agg(
        F.count_if(F.col("kept_content").isNull()).alias("lost"), F.count_if(F.col("content") != F.col("kept_content")).alias("other")).first()
    if found.lost:
        raise RuntimeError(f"{found.lost} texts have a kept locator that leads to no text of their digest")
    return not found.other


def _by_content(source: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Rows and states with the bytes themselves as the key, for a digest that doesn't tell texts apart."""
    text = F.col("row_.text").cast("string")
    rows = cut_lineage(source.select(
        "file", "row", F.col("row_.doc_id").cast("long").alias("doc_id"), normalised(text).alias("digest"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_points")), "contents")
    return rows, keyed_state(rows)


def _decided(docs: DataFrame, batch_bytes: int | None, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """The located documents, and for each its file, row, doc_id, digest and the state of its group."""
    source = located(docs)
    rows = fingerprints(source, digest)
    states = cut_lineage(run_stream(rows, batch_bytes), "dedup-states")
    if check_bytes(source, rows, states):
        return source, rows.join(states.select("digest", "group_size", "keep"), "digest")
    rows, states = _by_content(source, digest)
    return source, rows.join(states, "digest").withColumn("digest", digest(F.col("digest")))


def _stays() -> Column:
    return (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))


def deduplicate(docs: DataFrame, batch_bytes: int | None = None, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, locator) with one row per row of ``docs``; the locator is that of the
    row that stays: its file, '#' and the number of the row."""
    _, rows = _decided(docs, batch_bytes, digest)
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", _stays().alias("kept"),
                       F.col("digest").alias("text_sha256"), F.concat_ws("#", "keep.file", F.col("keep.row").cast("string")).alias("locator"))


def kept_rows(docs: DataFrame, batch_bytes: int | None = None, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; they are found again by their locators."""
    source, rows = _decided(docs, batch_bytes, digest)
    return marked(source, rows.where(_stays())).select("row_.*")
