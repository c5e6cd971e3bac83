"""Streams: stream result == batch result; a restart from the checkpoint adds nothing."""

import pytest
from pyspark.sql import functions as F

from reviewlake.operators.upsert import KeyedTable
from reviewlake.plans import standins
from reviewlake.sources.tables import table
from reviewlake.streaming import stateful
from reviewlake.streaming import streams as st

BASE = "/root/testdata/sf0.001"


def _landed(spark, tmp_dir):
    msgs = standins.messages(table(spark, BASE, "events"))
    return msgs, st.land_messages(msgs, f"{tmp_dir}/landing", 3)


def test_dedupe_stream_equals_batch_and_restart(spark, tmp_dir):
    msgs, landing = _landed(spark, tmp_dir)
    stream = st.decode(st.read_topic(spark, "t", path=landing, max_files_per_trigger=1), st.MESSAGE_SCHEMA)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    st.run_available(st.category_feed(stream).select("id", "name"), st.append_sink(out), ckpt)
    first = sorted(tuple(r) for r in spark.read.parquet(f"{out}/data").select("id", "name").collect())
    assert first == sorted(tuple(r) for r in msgs.select("id", "name").distinct().collect())
    # restart from the same checkpoint: nothing new, nothing duplicated
    stream2 = st.decode(st.read_topic(spark, "t", path=landing, max_files_per_trigger=1), st.MESSAGE_SCHEMA)
    st.run_available(st.category_feed(stream2).select("id", "name"), st.append_sink(out), ckpt)
    assert spark.read.parquet(f"{out}/data").count() == len(first)


def test_watermark_dedupe(spark, tmp_dir):
    msgs, landing = _landed(spark, tmp_dir)
    stream = st.decode(st.read_topic(spark, "t", path=landing), st.MESSAGE_SCHEMA)
    out = f"{tmp_dir}/out"
    feed = st.category_feed(stream, watermark=("ts", "1 hour")).select("id", "name", "ts")
    st.run_available(feed, st.append_sink(out), f"{tmp_dir}/ckpt")
    n = spark.read.parquet(f"{out}/data").count()
    assert msgs.select("id", "name").distinct().count() <= n <= msgs.count()


def test_upsert_stream_and_dual_write(spark, tmp_dir):
    msgs, landing = _landed(spark, tmp_dir)
    stream = st.decode(st.read_topic(spark, "t", path=landing, max_files_per_trigger=1), st.MESSAGE_SCHEMA)
    t = KeyedTable(spark, f"{tmp_dir}/table", "id", buckets=4)
    st.run_available(stream.select("id", "name", "ts", "event_id"),
                     st.dual_write(t, order=["ts", "event_id"]), f"{tmp_dir}/ckpt")
    got = sorted((r["id"], r["event_id"]) for r in t.read().collect())
    exp = sorted((r["id"], r["event_id"]) for r in msgs.groupBy("id").agg(
        F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id")).collect())
    assert got == exp
    sent, version = t.messages()
    assert sent.count() == msgs.count()
    assert t.messages(version)[0].count() == 0 and t.messages(version)[1] == version
    later = sum(t.messages(v)[0].count() - t.messages(v + 1)[0].count() for v in range(version))      # resumed from each version
    assert later == msgs.count()


@pytest.mark.parametrize("fails", ["data", "manifest"])
def test_dual_write_shows_row_and_message_together_or_not_at_all(spark, tmp_dir, monkeypatch, fails):
    """The write of the rows fails after the messages are written, or the commit after both; a replay brings each once."""
    t = KeyedTable(spark, f"{tmp_dir}/table", "id", buckets=4)
    sink = st.dual_write(t, order=["at"])
    batch = lambda rows: spark.createDataFrame(rows, "id long, name string, at long")
    sink(batch([(1, "a", 1)]), 0)

    def broken(*_args, **_kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        if fails == "manifest":
            m.setattr(KeyedTable, "_commit", broken)
        else:
            m.setattr("reviewlake.operators.upsert.cut_lineage", broken)
        with pytest.raises(RuntimeError):
            sink(batch([(1, "b", 2), (2, "c", 2)]), 1)
    values = lambda after=0: sorted(r.value for r in t.messages(after)[0].collect())
    assert [tuple(r) for r in t.read().collect()] == [(1, "a", 1)] and len(values()) == 1
    sink(batch([(1, "b", 2), (2, "c", 2)]), 1)
    sink(batch([(1, "b", 2), (2, "c", 2)]), 1)                       # a replay after the commit
    assert sorted((r.id, r.name) for r in t.read().collect()) == [(1, "b"), (2, "c")]
    assert len(values()) == 3 and len(values(1)) == 2 and t.messages(1)[1] == 2
    with monkeypatch.context() as m:                                # messages of a lost batch, then a batch without any
        m.setattr(KeyedTable, "_commit", broken)
        with pytest.raises(RuntimeError):
            sink(batch([(3, "lost", 3)]), 2)
    t.upsert(batch([(4, "d", 4)]), order=["at"], whole_row=True)
    assert len(values()) == 3 and 3 not in {r.id for r in t.read().collect()}


def _land(spark, folder, rows, schema):
    st.land_messages(spark.createDataFrame(rows, schema).coalesce(1), folder)


def test_retry_then_store_or_set_aside(spark, tmp_dir):
    """Key 1 parses at its third arrival, key 2 fails five times; the count goes on after a restart."""
    schema = "id long, seq long, value string"
    good, bad, out, ckpt = '{"a": 1}', "{broken", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def run():
        raw = st.decode(st.read_topic(spark, "t", path=f"{tmp_dir}/in/*"), schema)
        stateful.run_until_idle(stateful.retry(raw, "a int", wait_seconds=3600), st.append_sink(out), ckpt)
        return sorted(tuple(r) for r in spark.read.parquet(f"{out}/data").select("id", "seq", "state", "tries").collect())
    _land(spark, f"{tmp_dir}/in/0", [(1, 1, bad), (2, 1, bad), (2, 2, None), (3, 1, good), (1, 2, bad)], schema)
    assert run() == [(1, 1, "again", 1), (1, 2, "again", 2), (2, 1, "again", 1), (2, 2, "again", 2), (3, 1, "stored", 1)]
    _land(spark, f"{tmp_dir}/in/1", [(2, 5, bad), (2, 4, bad), (2, 3, bad), (1, 3, good), (2, 6, bad), (1, 4, bad)], schema)
    assert run()[2:] == [(1, 3, "stored", 3), (1, 4, "again", 1), (2, 1, "again", 1), (2, 2, "again", 2), (2, 3, "again", 3),
                         (2, 4, "again", 4), (2, 5, "set aside", 5), (2, 6, "again", 1), (3, 1, "stored", 1)]


def test_retry_counts_tries_that_never_come(spark, tmp_dir):
    """Without another arrival the timer counts, until the message is set aside and its state is gone."""
    import time
    _land(spark, f"{tmp_dir}/in/0", [(1, 1, "{broken"), (2, 1, '{"a": 1}')], "id long, seq long, value string")
    raw = st.decode(st.read_topic(spark, "t", path=f"{tmp_dir}/in/*"), "id long, seq long, value string")
    out = f"{tmp_dir}/out"
    q = (stateful.retry(raw, "a int", max_tries=3, wait_seconds=0.2).writeStream.foreachBatch(st.append_sink(out))
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(processingTime="0 seconds").start())
    read = lambda: sorted(tuple(r) for r in spark.read.schema("id long, state string, tries int").parquet(
        f"{out}/data").select("id", "state", "tries").collect())
    end = time.time() + 60
    try:
        while time.time() < end and ((1, "set aside", 3) not in (read() if q.lastProgress else [])):
            assert q.exception() is None
            time.sleep(0.5)
        assert read() == [(1, "again", 1), (1, "again", 2), (1, "set aside", 3), (2, "stored", 1)]
    finally:
        q.stop()


def test_category_feed_starts_with_history_and_forgets(spark, tmp_dir):
    """What the history holds isn't sent; the state holds only keys that arrived within the time-to-live."""
    import time
    schema, out, ckpt = "id long, name string", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    history = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], schema)
    raw = st.decode(st.read_topic(spark, "t", path=f"{tmp_dir}/in/*"), schema)
    _land(spark, f"{tmp_dir}/in/0", [(1, "a"), (3, "c"), (3, "c"), (2, "other"), (None, "x")], schema)
    feed = stateful.bounded_category_feed(raw, ttl_seconds=2, history=history)
    q = (feed.writeStream.foreachBatch(st.append_sink(out)).option("checkpointLocation", ckpt).trigger(processingTime="0 seconds").start())
    size = lambda: q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None
    sent = lambda: sorted((tuple(r) for r in spark.read.schema(schema).parquet(f"{out}/data").select("id", "name").collect()), key=str)
    try:
        stateful.wait_until_idle(q)
        assert sent() == [(2, "other"), (3, "c"), (None, "x")]
        sizes = []
        for i in range(1, 6):                                       # 200 new keys each time, none of them seen again
            time.sleep(1.5)
            _land(spark, f"{tmp_dir}/in/{i}", [(1000 * i + j, "n") for j in range(200)], schema)
            stateful.wait_until_idle(q)
            sizes.append(size())
        time.sleep(3)
        end = time.time() + 30
        while size() and time.time() < end:
            time.sleep(0.3)
        assert size() == 0 and max(sizes) < 1000 and len(sent()) == 3 + 5 * 200
    finally:
        q.stop()


def test_rows_that_come_late_still_enrich(spark, tmp_dir):
    """The id is in the first batch, its row in the second; an id without a row comes out once the watermark is past."""
    at = lambda minute: f"2024-01-01 00:{minute:02}:00"
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def run():
        ids = st.decode(st.read_topic(spark, "a", path=f"{tmp_dir}/ids/*"), "id long, ts timestamp")
        rows = st.decode(st.read_topic(spark, "b", path=f"{tmp_dir}/rows/*"), "id long, row_ts timestamp, name string")
        found = stateful.enrich_late(ids, rows, "id", "ts", "row_ts", "0 MINUTES", "10 MINUTES", "1 MINUTE")
        st.run_available(found, st.append_sink(out), ckpt)
        return sorted(((r.id, r.name) for r in spark.read.schema("id long, name string").parquet(f"{out}/data").collect()), key=str)
    _land(spark, f"{tmp_dir}/ids/0", [(1, at(0)), (2, at(0))], "id long, ts string")
    _land(spark, f"{tmp_dir}/rows/0", [(9, at(0), "z")], "id long, row_ts string, name string")
    assert run() == []
    _land(spark, f"{tmp_dir}/rows/1", [(1, at(5), "late")], "id long, row_ts string, name string")
    assert run() == [(1, "late")]
    _land(spark, f"{tmp_dir}/ids/2", [(3, at(50))], "id long, ts string")
    _land(spark, f"{tmp_dir}/rows/2", [(9, at(50), "z")], "id long, row_ts string, name string")
    assert run() == [(1, "late"), (2, None)]


def test_enrich_and_quarantine(spark, tmp_dir):
    _msgs, landing = _landed(spark, tmp_dir)
    stream = st.decode(st.read_topic(spark, "t", path=landing), st.MESSAGE_SCHEMA)
    cust = table(spark, BASE, "customer").select("c_custkey", "c_name")
    out = f"{tmp_dir}/out"
    st.run_available(st.enrich_ids(stream.select("event_id", "id"), cust, "id", "c_custkey"), st.append_sink(out),
                     f"{tmp_dir}/ckpt")
    assert spark.read.parquet(f"{out}/data").count() == table(spark, BASE, "events").count()
    raw = spark.createDataFrame([('{"k": 1}',), ("{bad",), (None,)], "value string")
    good, bad = st.quarantine(raw, "k int")
    assert good.count() == 1 and bad.count() == 2


def test_index_ratings_and_categories(spark, tmp_dir):
    from pyspark.sql import functions as F

    from reviewlake.operators.upsert import KeyedTable, review_table
    docs = spark.createDataFrame([(1, "t", "c", 9, 5), (2, "u", "d", 8, 1)],
                                 "id long, title string, content string, customer_id long, rating int")
    landing = st.land_messages(docs.withColumn("rating", F.col("rating").cast("string")), f"{tmp_dir}/in", 1)
    t = review_table(spark, f"{tmp_dir}/ratings", buckets=2)
    q = st.index_ratings(st.read_topic(spark, "r", path=landing), t, f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    assert sorted((r["id"], r["rating"]) for r in t.read().collect()) == [(1, 5), (2, 1)]
    cats = spark.createDataFrame([("(1, 'Sách')",), ("(2, 'Áo')",), ("bad",)], "value string")
    cats.write.text(f"{tmp_dir}/cats")
    ct = KeyedTable(spark, f"{tmp_dir}/cat_table", "id", buckets=2)
    st.maintain_categories(st.read_topic(spark, "c", path=f"{tmp_dir}/cats"), ct, f"{tmp_dir}/ck2").awaitTermination()
    assert sorted(tuple(r) for r in ct.read().select("id", "name").collect()) == [(1, "Sách"), (2, "Áo")]


def test_index_survives_real_messages(spark, tmp_dir):
    """Duplicate keys, broken JSON, missing keys, a batch of bad messages only, and a second checkpoint."""
    from reviewlake.operators.upsert import product_table, review_table
    write = lambda name, lines: spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(
        f"{tmp_dir}/in/{name}")
    table_, bad = review_table(spark, f"{tmp_dir}/t", 2), f"{tmp_dir}/bad"

    def index(checkpoint, folder):
        st.index_ratings(st.read_topic(spark, "r", path=folder, max_files_per_trigger=1), table_, f"{tmp_dir}/{checkpoint}",
                         available_now=True, quarantine_path=f"{bad}/{checkpoint}").awaitTermination()
    write("a", ['{"id": 1, "title": "old"}', '{broken', '{"title": "no key"}', '{"id": 1, "title": "new"}'])
    index("c1", f"{tmp_dir}/in/a")
    assert [(r["id"], r["title"]) for r in table_.read().collect()] == [(1, "new")]
    write("b", ["{broken", "also broken"])
    index("c2", f"{tmp_dir}/in/b")                                   # only bad messages
    write("c", ['{"id": 2, "title": "second"}'])
    index("c3", f"{tmp_dir}/in/c")                                   # batch 0 of a new checkpoint
    assert sorted((r["id"], r["title"]) for r in table_.read().collect()) == [(1, "new"), (2, "second")]
    kept = sorted(r["value"] for c in ("c1", "c2") for r in spark.read.parquet(f"{bad}/{c}/data").select("value").collect())
    assert kept == sorted(["{broken", '{"title": "no key"}', "{broken", "also broken"])
    assert product_table(spark, f"{tmp_dir}/none").read() is None


def test_kafka_options():
    assert st.kafka_options("t", "h:1") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}


def test_failures_of_a_null_key_are_not_counted_for_another(spark, tmp_dir):
    """Before, the open failures of messages without a key were taken for those of the next key."""
    rows = [(None, s, "{broken") for s in range(3)] + [(k, 10 + k, '{"a": 1}') for k in range(60)]
    from reviewlake.session import state_session
    messages = spark.createDataFrame(rows, "id long, seq long, value string")
    landing = st.land_messages(messages.coalesce(1), f"{tmp_dir}/landing")
    raw = st.decode(st.read_topic(state_session(spark), "retry", path=landing, max_files_per_trigger=8), "id long, seq long, value string")
    stateful.run_until_idle(stateful.retry(raw, "a long", wait_seconds=3600), st.append_sink(f"{tmp_dir}/out"), f"{tmp_dir}/checkpoint")
    got = spark.read.parquet(f"{tmp_dir}/out/data")
    assert got.where("id IS NOT NULL").select(F.min("tries"), F.max("tries"), F.count("*")).first()[:] == (1, 1, 60)
    assert sorted(r.tries for r in got.where("id IS NULL").collect()) == [1, 2, 3]
