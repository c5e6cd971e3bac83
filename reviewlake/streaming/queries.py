"""Registered streaming queries: events are landed as JSON messages (a topic stand-in), consumed
by a Structured Streaming query in several micro-batches (``maxFilesPerTrigger``,
``availableNow``) and written through idempotent sinks; the query result is the sink table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import misc
from reviewlake.operators.upsert import KeyedTable
from reviewlake.plans import standins
from reviewlake.session import cut_lineage, state_session
from reviewlake.sources.tables import table
from reviewlake.streaming import stateful
from reviewlake.streaming import streams as st



def _message_stream(spark: SparkSession, base: str, name: str) -> DataFrame:
    landing = st.land_messages(standins.messages(table(spark, base, "events")), st.scratch(spark, f"{name}-landing"))
    raw = st.read_topic(spark, "events", path=landing, max_files_per_trigger=1)
    return st.decode(raw, st.MESSAGE_SCHEMA)


def stream_dedupe(spark: SparkSession, base: str) -> DataFrame:
    """Each (id, name) category message once."""
    out = st.scratch(spark, "stream-dedupe-out")
    feed = st.category_feed(_message_stream(spark, base, "dedupe")).select("id", "name")
    st.run_available(feed, st.append_sink(out), st.scratch(spark, "stream-dedupe-ckpt"))
    return spark.read.parquet(f"{out}/data").select("id", "name")


def stream_upsert(spark: SparkSession, base: str) -> DataFrame:
    """R2 / K7: keyed table of the latest name per id (version = (ts, event_id))."""
    t = KeyedTable(spark, st.scratch(spark, "stream-upsert-table"), "id", buckets=16)
    msgs = _message_stream(spark, base, "upsert").select("id", "name", "ts", "event_id")
    st.run_available(msgs, st.upsert_sink(t, order=["ts", "event_id"]), st.scratch(spark, "stream-upsert-ckpt"))
    return t.read().select("id", "name", "event_id")


def stream_enrich(spark: SparkSession, base: str) -> DataFrame:
    """Id messages enriched from a static keyed table (stream-static left join)."""
    out = st.scratch(spark, "stream-enrich-out")
    cust = table(spark, base, "customer").select("c_custkey", "c_name")
    msgs = _message_stream(spark, base, "enrich").select("event_id", "id")
    st.run_available(st.enrich_ids(msgs, cust, "id", "c_custkey"), st.append_sink(out),
                     st.scratch(spark, "stream-enrich-ckpt"))
    return spark.read.parquet(f"{out}/data").select("event_id", "id", "c_name")


def stream_fan_out(spark: SparkSession, base: str) -> DataFrame:
    """Category messages fanned out to the products listed under each category."""
    nat = table(spark, base, "nation").select(F.col("n_nationkey").cast("long").alias("category_id"),
                                              F.col("n_name").alias("name"))
    landing = st.land_messages(nat, st.scratch(spark, "fanout-landing"), 2)
    cats = st.decode(st.read_topic(spark, "categories", path=landing, max_files_per_trigger=1),
                     "category_id long, name string")
    listings = standins.product_rows(spark, base).select(F.col("categories.id").alias("category_id"),
                                                         F.col("id").alias("product_id"))
    out = st.scratch(spark, "stream-fanout-out")
    st.run_available(st.fan_out(cats, listings).select("category_id", "product_id"), st.append_sink(out),
                     st.scratch(spark, "stream-fanout-ckpt"))
    return spark.read.parquet(f"{out}/data").select("category_id", "product_id")


def props_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """Event properties parsed permissively; unparsable rows are kept aside."""
    ev = table(spark, base, "events").select("event_id", F.col("props").alias("value"))
    good, _bad = st.quarantine(ev, "k int")
    return good.select("event_id", "k")


def _landed_in_order(rows: DataFrame, key: str, order: str, folder: str, slices: int = 3) -> str:
    """Messages as in a topic: those of a key lie in one file of each slice, and slices of ``order`` come one after another."""
    bounds = rows.agg(F.percentile_approx(order, [i / slices for i in range(1, slices)]).alias("at")).first()["at"] or []
    part = sum((F.col(order) > b).cast("int") for b in bounds) if bounds else F.lit(0)
    for i in range(len(bounds) + 1):
        st.land_messages(rows.where(part == i).repartition(key), f"{folder}/slice-{i}")
    return f"{folder}/*"


def stream_retry(spark: SparkSession, base: str) -> DataFrame:
    """Messages of a key that don't parse are wanted again, and set aside after five failures in a row."""
    events = table(spark, base, "events")
    payload = F.when(F.col("event_id") % 7 < 4, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "event_type")))
    landing = _landed_in_order(events.select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), payload.alias("value")),
                               "id", "seq", st.scratch(spark, "retry-landing"))
    raw = st.decode(st.read_topic(state_session(spark), "retry", path=landing, max_files_per_trigger=8), "id long, seq long, value string")
    out = st.scratch(spark, "retry-out")
    tried = stateful.retry(raw, "event_id long, event_type string", wait_seconds=24 * 3600)
    stateful.run_until_idle(tried, st.append_sink(out), st.scratch(spark, "retry-checkpoint"))
    return spark.read.parquet(f"{out}/data").select("id", "seq", "state", "tries")


def stream_category_feed(spark: SparkSession, base: str) -> DataFrame:
    """What was sent before and what a feed with bounded state sends on; each (id, name) once."""
    events = standins.messages(table(spark, base, "events"))
    history = cut_lineage(events.where("event_id % 5 = 0").select("id", "name").distinct(), "feed-history")
    own = state_session(spark)
    landing = _landed_in_order(events.where("event_id % 5 > 0"), "id", "event_id", st.scratch(spark, "feed-landing"))
    raw = st.decode(st.read_topic(own, "categories", path=landing, max_files_per_trigger=8), st.MESSAGE_SCHEMA)
    out = st.scratch(spark, "feed-out")
    feed = stateful.bounded_category_feed(raw, ttl_seconds=24 * 3600, history=own.read.parquet(*history.inputFiles()))
    stateful.run_until_idle(feed, st.append_sink(out), st.scratch(spark, "feed-checkpoint"))
    return history.unionByName(spark.read.parquet(f"{out}/data").select("id", "name"))


def stream_enrich_late(spark: SparkSession, base: str) -> DataFrame:
    """Ids (even events) with the rows (odd events) of their user up to six hours before or after, from two feeds."""
    events = standins.messages(table(spark, base, "events"))
    end = spark.sql("SELECT -1L AS event_id, TIMESTAMP '2100-01-01' AS ts, -1L AS id, 'end of feed' AS name")
    feeds = []
    for i in (0, 1):
        folder = st.scratch(spark, f"late-landing-{i}")
        landing = _landed_in_order(events.where(f"event_id % 2 = {i}"), "id", "event_id", folder)
        st.land_messages(end, f"{folder}/slice-end")
        feeds.append(st.decode(st.read_topic(spark, "late", path=landing, max_files_per_trigger=8), st.MESSAGE_SCHEMA))
    rows = feeds[1].select("id", F.col("ts").alias("row_ts"), F.concat_ws(" ", "name", "event_id").alias("found"))
    found = stateful.enrich_late(feeds[0].select("event_id", "id", "ts"), rows, "id", "ts", "row_ts", "6 HOURS", "6 HOURS", "30 days")
    out = st.scratch(spark, "late-out")
    st.run_available(found, st.append_sink(out), st.scratch(spark, "late-checkpoint"))
    return spark.read.parquet(f"{out}/data").where("id >= 0").select("event_id", "id", "found")


def _topics(spark: SparkSession, base: str, name: str, message: Column) -> list[str]:
    """Two landing folders of messages made from events (even and odd event ids) and one of broken messages
    only. As in a topic, the messages of one user lie in one file, in order; broken ones are among them."""
    events = table(spark, base, "events")
    broken = F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).when(F.col("event_id") % 89 == 0, F.lit('{"other": 1}'))
    out = []
    for i, part in enumerate((events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"), events.where("event_id % 97 = 0"))):
        value = F.coalesce(broken, message) if i < 2 else F.lit("{broken")
        folder = st.scratch(spark, f"{name}-landing-{i}")
        part.repartition("user_id").sortWithinPartitions("ts", "event_id").select(value.alias("value")).write.text(folder)
        out.append(folder)
    return out


def _indexed(spark: SparkSession, base: str, name: str, start, key: str, message: Column):
    """Index all landing folders, each with a checkpoint of its own, into one keyed table."""
    t = KeyedTable(spark, st.scratch(spark, f"{name}-table"), key, buckets=8)
    bad = st.scratch(spark, f"{name}-bad")
    for i, folder in enumerate(_topics(spark, base, name, message)):
        start(st.read_topic(spark, name, path=folder), t, st.scratch(spark, f"{name}-checkpoint"),
              available_now=True, quarantine_path=f"{bad}/{i}").awaitTermination()
    return t, bad


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def stream_categories(spark: SparkSession, base: str) -> DataFrame:
    """R2 + P21: category messages as text, the last name of each id."""
    message = misc.to_tuple_message("user_id", F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")))
    t = KeyedTable(spark, st.scratch(spark, "categories-table"), "id", buckets=8)
    for folder in _topics(spark, base, "categories", message):
        st.maintain_categories(st.read_topic(spark, "categories", path=folder), t,
                               st.scratch(spark, "categories-checkpoint")).awaitTermination()
    return t.read().select("id", "name")


def stream_index_products(spark: SparkSession, base: str) -> DataFrame:
    """Product documents keyed by ``{date}_{id}``; the last message of a key wins whole."""
    message = _json(key=F.concat(misc.day(F.col("ts")), F.lit("_"), F.col("user_id").cast("string")), id=F.col("user_id"),
                    name=F.col("event_type"), price=F.col("event_id").cast("string"), time=misc.day(F.col("ts")),
                    is_best_store=F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 3 == 1))
    t, _ = _indexed(spark, base, "products", st.index_products, "key", message)
    return t.read().select("key", "id", "name", "price", "time", "is_best_store", "brand_name")


def stream_index_ratings(spark: SparkSession, base: str) -> DataFrame:
    """Rating documents keyed by id; a customer id that is no number becomes null."""
    message = _json(id=F.col("user_id"), title=F.col("event_type"), content=F.col("event_id").cast("string"),
                    customer_id=F.when(F.col("event_id") % 5 == 0, F.lit("none")).otherwise(F.col("event_id").cast("string")),
                    rating=(F.col("event_id") % 5).cast("int"))
    t, _ = _indexed(spark, base, "ratings", st.index_ratings, "id", message)
    return t.read().select("id", "title", "content", "customer_id", "rating")


def stream_index_overviews(spark: SparkSession, base: str) -> DataFrame:
    """Overview documents keyed by product id."""
    message = _json(product_id=F.col("user_id"), name_product=F.col("event_type"), stars_1_count=F.col("event_id"),
                    rating_average=F.col("event_id") / 2, review_photo=F.struct(F.col("event_id").alias("total")))
    t, _ = _indexed(spark, base, "overviews", st.index_overviews, "product_id", message)
    return t.read().select("product_id", "name_product", "stars_1_count", "stars_5_percent", "rating_average",
                           F.col("review_photo.total").alias("photos"))


def stream_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """R9 in R4: how many messages of each kind were set aside."""
    message = _json(id=F.col("user_id"), title=F.col("event_type"))
    _, bad = _indexed(spark, base, "quarantine", st.index_ratings, "id", message)
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(f"{bad}/{i}/data").select("value") for i in range(3)])
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def stream_dual_write(spark: SparkSession, base: str) -> DataFrame:
    """Every message goes on to the outgoing topic, the latest per id to the table."""
    t = KeyedTable(spark, st.scratch(spark, "dual-table"), "id", buckets=8)
    msgs = _message_stream(spark, base, "dual").select("id", "name", "ts", "event_id")
    st.run_available(msgs, st.dual_write(t, order=["ts", "event_id"]), st.scratch(spark, "dual-checkpoint"))
    messages, _version = t.messages()
    sent = messages.select(F.from_json("value", "id long").alias("m")).groupBy("m.id").agg(F.count(F.lit(1)).alias("n_sent"))
    return t.read().select("id", "name", "event_id").join(sent, "id")


STREAM_QUERIES = {
    "stream_dedupe": stream_dedupe,
    "stream_upsert": stream_upsert,
    "stream_enrich": stream_enrich,
    "stream_fan_out": stream_fan_out,
    "props_quarantine": props_quarantine,
    "stream_categories": stream_categories,
    "stream_index_products": stream_index_products,
    "stream_index_ratings": stream_index_ratings,
    "stream_index_overviews": stream_index_overviews,
    "stream_quarantine": stream_quarantine,
    "stream_dual_write": stream_dual_write,
    "stream_retry": stream_retry,
    "stream_category_feed": stream_category_feed,
    "stream_enrich_late": stream_enrich_late,
}


def stream_oracles() -> dict[str, str]:
    from reviewlake.plans.oracles import PRODUCTS
    last = """QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY event_id % 2 DESC, ts DESC, event_id DESC) = 1"""
    by_user = last.format(key="user_id")
    good = "events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"
    return {
        "stream_categories": f"SELECT user_id AS id, event_type || ' ' || event_id AS name FROM {good} {by_user}",
        "stream_index_products": f"""SELECT strftime(ts, '%Y-%m-%d') || '_' || user_id AS key, user_id AS id, event_type AS name,
CAST(event_id AS DOUBLE) AS price, strftime(ts, '%Y-%m-%d') AS time,
CASE WHEN event_id % 3 > 0 THEN event_id % 3 = 1 END AS is_best_store, CAST(NULL AS VARCHAR) AS brand_name
FROM {good} {last.format(key="strftime(ts, '%Y-%m-%d') || '_' || user_id")}""",
        "stream_index_ratings": f"""SELECT user_id AS id, event_type AS title, CAST(event_id AS VARCHAR) AS content,
CASE WHEN event_id % 5 <> 0 THEN event_id END AS customer_id, CAST(event_id % 5 AS INTEGER) AS rating FROM {good} {by_user}""",
        "stream_index_overviews": f"""SELECT user_id AS product_id, event_type AS name_product, event_id AS stars_1_count,
CAST(NULL AS DOUBLE) AS stars_5_percent, event_id / 2 AS rating_average, event_id AS photos FROM {good} {by_user}""",
        "stream_quarantine": """SELECT '{broken' AS value, 2 * count(*) AS n FROM events WHERE event_id % 97 = 0
UNION ALL SELECT '{"other": 1}', count(*) FROM events WHERE event_id % 89 = 0 AND event_id % 97 <> 0 HAVING count(*) > 0""",
        "stream_dual_write": """SELECT user_id AS id, event_type AS name, event_id, count(*) OVER (PARTITION BY user_id) AS n_sent FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "stream_retry": """WITH e AS (SELECT user_id AS id, event_id AS seq, event_id % 7 >= 4 AS good FROM events),
r AS (SELECT *, coalesce(sum(CAST(good AS INTEGER)) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM e),
t AS (SELECT *, count(*) OVER (PARTITION BY id, run ORDER BY seq) AS n FROM r)
SELECT id, seq, CASE WHEN good THEN 'stored' WHEN n % 5 = 0 THEN 'set aside' ELSE 'again' END AS state,
       CAST((n - 1) % 5 + 1 AS INTEGER) AS tries FROM t""",
        "stream_category_feed": "SELECT DISTINCT user_id AS id, event_type AS name FROM events",
        "stream_enrich_late": """SELECT i.event_id, i.user_id AS id, r.event_type || ' ' || r.event_id AS found
FROM (SELECT * FROM events WHERE event_id % 2 = 0) i LEFT JOIN (SELECT * FROM events WHERE event_id % 2 = 1) r
ON r.user_id = i.user_id AND r.ts BETWEEN i.ts - INTERVAL 6 HOUR AND i.ts + INTERVAL 6 HOUR""",
        "stream_dedupe": "SELECT DISTINCT user_id AS id, event_type AS name FROM events",
        "stream_upsert": """SELECT user_id AS id, event_type AS name, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "stream_enrich": """SELECT event_id, user_id AS id, c_name FROM events LEFT JOIN customer ON c_custkey = user_id""",
        "stream_fan_out": f"""WITH {PRODUCTS.strip()}
SELECT CAST(n_nationkey AS BIGINT) AS category_id, id AS product_id FROM products WHERE n_nationkey IS NOT NULL""",
        "props_quarantine": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    }
