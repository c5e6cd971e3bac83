"""Structured Streaming operators.

Topics are Kafka in production (``read_topic``) and a folder of landed JSON messages in tests (the
Kafka connector jar is not on this image). Every sink is a ``foreachBatch`` writing an idempotent,
keyed upsert, with a checkpoint in the shared folder: the reference's consumers were at-most-once
(no group id, no checkpoint); these are at-least-once with replay-safe writes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import misc
from reviewlake.operators.sinks import to_message
from reviewlake.operators.upsert import KeyedTable
from reviewlake.session import list_folder, scratch_path

MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
])


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, path: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to a topic from the latest offset (Kafka), or tail a landing folder.

    Both give a ``value: string`` column holding one JSON message per row, and ``arrived``, a struct
    that orders messages: time, partition and offset of a topic; time, name and block of a file.
    """
    if servers:
        raw = spark.readStream.format("kafka").options(**kafka_options(topic, servers)).load()
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.struct("timestamp", F.col("partition").cast("string").alias("place"),
                                   F.col("offset").alias("at")).alias("arrived"))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("value", F.struct(
        F.col("_metadata.file_modification_time").alias("timestamp"), F.col("_metadata.file_name").alias("place"),
        F.col("_metadata.file_block_start").alias("at")).alias("arrived"))


def kafka_options(topic: str, servers: str) -> dict[str, str]:
    """Source options: every message after the start of the query, none lost on a restart."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"}


def land_messages(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write rows as JSON-line messages into a landing folder; ``files`` sets the number of part files."""
    messages = to_message(df)
    (messages.repartition(files) if files else messages).write.mode("overwrite").text(path)
    return path


def decode(stream: DataFrame, schema: T.StructType | str, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """V5: JSON message -> typed columns; ``keep`` names columns that stay beside them."""
    return stream.select(F.from_json(F.col(col), schema).alias("m"), *keep).select("m.*", *keep)


def category_feed(messages: DataFrame, keys: Sequence[str] = ("id", "name"),
                  watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each (id, name) once. Without a watermark the state keeps every key, as the reference
    did for its process lifetime; with one, ``dropDuplicatesWithinWatermark`` bounds the state."""
    if watermark:
        return messages.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))
    return messages.dropDuplicates(list(keys))


def parse_category_text(stream: DataFrame, col: str = "value") -> DataFrame:
    """P21 on a stream: ``(id, 'name')`` text messages."""
    id_, name = misc.parse_tuple_message(col)
    return stream.select(id_.alias("id"), name.alias("name"))


def enrich_ids(stream: DataFrame, table: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Stream-static left join (the static side is re-read per micro-batch)."""
    return stream.join(table, stream[left_key] == table[right_key], "left").drop(table[right_key])


def fan_out(stream: DataFrame, listings: DataFrame, key: str = "category_id") -> DataFrame:
    """Category message -> one row per listed product (stream-static inner join)."""
    return stream.join(listings, key, "inner")


def _permissive(raw: str | Column, schema: T.StructType | str, corrupt_col: str) -> Column:
    """The parsed message, with its text in ``corrupt_col`` if it does not parse."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return F.from_json(raw, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})


def parse_error(raw_col: str, schema: T.StructType | str) -> Column:
    """The text of a message that does not parse; null for one that does."""
    return _permissive(raw_col, schema, "_corrupt_record")["_corrupt_record"]


def quarantine(df: DataFrame, schema: T.StructType | str, raw_col: str = "value",
               corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Parse JSON permissively; rows that do not parse (or are null) go to a quarantine frame
    instead of failing the batch or being silently dropped."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parsed = df.withColumn("_p", _permissive(raw_col, schema, corrupt_col))
    ok = F.col(raw_col).isNotNull() & F.col(f"_p.{corrupt_col}").isNull()
    good = parsed.filter(ok).select("*", *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]).drop("_p")
    bad = parsed.filter(~ok).drop("_p")
    return good, bad


ARRIVAL = ("arrived", "_row")


def _with_row(batch: DataFrame) -> DataFrame:
    """Adds the place of a row among those that arrived together."""
    return batch.withColumn("_row", F.monotonically_increasing_id())


def upsert_sink(table: KeyedTable, order: Sequence[str] | None = None, whole_row: bool = True, query: str = "upsert"
                ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer. Of a key's rows the last by ``order`` wins, else the last that
    arrived (the batch then needs ``arrived``). A batch that ``query`` has committed is skipped."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        arrival = ARRIVAL if "arrived" in batch.columns else ARRIVAL[1:]
        if order is None and "arrived" not in batch.columns:
            raise ValueError("the batch has neither order columns nor the arrival of its messages")
        table.upsert(_with_row(batch), order=order, arrival=arrival, batch_id=batch_id, whole_row=whole_row, query=query)
    return sink


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch in a folder of its own, complete when Spark marks it; a replay writes it anew."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/data/batch={batch_id}"
        if "_SUCCESS" not in list_folder(batch.sparkSession, folder):
            batch.write.mode("overwrite").parquet(folder)
    return sink


def dual_write(table: KeyedTable, order: Sequence[str] | None = None, query: str = "dual") -> Callable[[DataFrame, int], None]:
    """One micro-batch -> rows of the keyed table and outgoing messages, in one commit.

    Rows and messages of a batch become visible together, by the table's manifest, or not at all; a batch that was
    committed is skipped on replay, so no message goes out twice. ``KeyedTable.messages`` reads them from a version on."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            arrival = ARRIVAL if "arrived" in rows.columns else ARRIVAL[1:]
            table.upsert(_with_row(rows), order=order, arrival=arrival, batch_id=batch_id, whole_row=True, query=query,
                         messages=to_message(rows.drop("arrived")))
        finally:
            rows.unpersist()
    return sink


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available now, in micro-batches, then stop (``availableNow``)."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def as_timestamp(c: str | Column) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` (watermarks need the latter; session zone UTC)."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def start_index(stream: DataFrame, schema: T.StructType, table: KeyedTable, checkpoint: str,
                order: Sequence[str] | None = None, available_now: bool = False,
                processing_time: str | None = None, quarantine_path: str | None = None):
    """JSON documents from a topic -> typed (conformed) documents -> keyed whole-document
    upsert per micro-batch. Messages that are no JSON object, or lack the key, are no documents; they
    go to ``quarantine_path`` if given. The checkpoint names the writer: a query with a new
    checkpoint counts its batches anew. Returns the running StreamingQuery."""
    from reviewlake.operators.sinks import conform
    # read scalars as text, then try_cast to the mapping: a number sent as "5" still lands as 5,
    # and a value that does not fit becomes NULL instead of failing the micro-batch
    lenient = T.StructType([T.StructField(f.name, f.dataType if isinstance(
        f.dataType, (T.StructType, T.ArrayType, T.MapType)) else T.StringType()) for f in schema.fields])
    upsert = upsert_sink(table, order=order, whole_row=True, query=checkpoint)
    keep_bad = append_sink(quarantine_path) if quarantine_path else None

    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed, bad = quarantine(batch, lenient)
        documents = conform(parsed, schema, keep=["value", "arrived"])
        keyed = F.array_contains(F.array(*[F.col(k).isNull() for k in table.keys]), True) == F.lit(False)
        upsert(documents.where(keyed).drop("value"), batch_id)
        if quarantine_path:
            keep_bad(bad.select("value").unionByName(documents.where(~keyed).select("value")), batch_id)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def index_products(stream: DataFrame, table: KeyedTable, checkpoint: str, **kw):
    """Product documents keyed by ``key`` (``{date}_{id}``)."""
    from reviewlake.schemas import PRODUCT_DOCUMENT
    return start_index(stream, PRODUCT_DOCUMENT, table, checkpoint, **kw)


def index_ratings(stream: DataFrame, table: KeyedTable, checkpoint: str, **kw):
    """Rating documents keyed by review ``id``."""
    from reviewlake.schemas import RATING_DOCUMENT
    return start_index(stream, RATING_DOCUMENT, table, checkpoint, **kw)


def index_overviews(stream: DataFrame, table: KeyedTable, checkpoint: str, **kw):
    """Overview documents keyed by ``product_id``."""
    from reviewlake.schemas import OVERVIEW_DOCUMENT
    return start_index(stream, OVERVIEW_DOCUMENT, table, checkpoint, **kw)


def maintain_categories(stream: DataFrame, table: KeyedTable, checkpoint: str, text_messages: bool = True):
    """R2: category messages -> table of the last name per id (last arrival wins)."""
    if text_messages:
        id_, name = misc.parse_tuple_message("value")
        cats = stream.select(id_.alias("id"), name.alias("name"), "arrived")
    else:
        cats = decode(stream, "id long, name string", keep=["arrived"])
    return (cats.writeStream.foreachBatch(upsert_sink(table, whole_row=True, query=checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def category_feed_query(stream: DataFrame, out_path: str, checkpoint: str, interval: str = "60 seconds"):
    """R1 as a long-running query: poll every ``interval`` and emit each (id, name) once."""
    return (category_feed(stream).writeStream.foreachBatch(append_sink(out_path))
            .option("checkpointLocation", checkpoint).trigger(processingTime=interval).start())
