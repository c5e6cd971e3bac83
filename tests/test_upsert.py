"""Upserts: column-level merge, idempotence, in-batch duplicates, bucketed writer, snapshots."""

from pyspark.sql import functions as F

from reviewlake.operators import upsert as up

SCHEMA = "id long, name string, bal double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_semantics(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], SCHEMA)
    u = spark.createDataFrame([(2, None, 20.0, 1), (4, "d", 4.0, 1), (3, "x", None, 1), (3, None, 30.0, 2)],
                              SCHEMA + ", seq int")
    m = up.merge_upsert(t, u, "id", order=["seq"])
    # new key inserted; missing cell keeps old value; duplicate key in batch: per column last non-null
    assert rows(m) == [(1, "a", 1.0), (2, "b", 20.0), (3, "x", 30.0), (4, "d", 4.0)]
    # idempotent
    assert rows(up.merge_upsert(m, u, "id", order=["seq"])) == rows(m)


def test_replace_latest(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    u = spark.createDataFrame([(2, None, 5.0), (2, "z", 6.0), (3, "c", 3.0)], SCHEMA)
    m = up.replace_latest(t, u, "id", ["bal"])
    assert rows(m) == [(1, "a", 1.0), (2, "z", 6.0), (3, "c", 3.0)]


def test_keyed_table_writer(spark, tmp_dir):
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=4)
    b0 = spark.createDataFrame([(i, f"n{i}", float(i)) for i in range(20)], SCHEMA)
    seq = lambda df: df.withColumn("seq", F.lit(0))
    t.upsert(seq(b0), order=["seq"], batch_id=0)
    b1 = spark.createDataFrame([(3, None, 33.0), (25, "n25", 25.0)], SCHEMA)
    t.upsert(seq(b1), arrival=["seq"], batch_id=1)
    t.upsert(seq(b1).withColumn("bal", F.lit(-1.0)), arrival=["seq"], batch_id=1)     # replay of batch 1: skipped
    got = {r["id"]: (r["name"], r["bal"]) for r in t.read().collect()}
    assert len(got) == 21
    assert got[3] == ("n3", 33.0) and got[25] == ("n25", 25.0) and got[7] == ("n7", 7.0)


def test_keyed_table_needs_an_order_and_keeps_one_row_per_key(spark, tmp_dir):
    import pytest
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=4)
    twice = spark.createDataFrame([(1, "a", 1.0, 0), (1, "b", 2.0, 1), (None, "x", 3.0, 2)], SCHEMA + ", at int")
    with pytest.raises(ValueError):
        t.upsert(twice)
    t.upsert(twice, arrival=["at"], batch_id=0, query="q1", whole_row=True)
    assert rows(t.read()) == [(1, "b", 2.0)]                       # the last one; a null key is no document
    t.upsert(twice.where("false"), arrival=["at"], batch_id=1, query="q1", whole_row=True)      # an empty batch
    other = spark.createDataFrame([(2, "c", 3.0, 0)], SCHEMA + ", at int")
    t.upsert(other, arrival=["at"], batch_id=0, query="q2", whole_row=True)     # another writer counts anew
    t.upsert(other.withColumn("name", F.lit("z")), arrival=["at"], batch_id=1, query="q1", whole_row=True)   # replay
    assert rows(t.read()) == [(1, "b", 2.0), (2, "c", 3.0)]


def test_keyed_table_keeps_few_versions_and_the_type_of_its_partition_column(spark, tmp_dir):
    from reviewlake.session import list_folder
    for i in range(6):
        b = spark.createDataFrame([("2024-01-01", i, 5.0, 1)], "time string, id long, qty double, seq int")
        up.write_daily_snapshot(spark, tmp_dir, b, ["seq"], batch_id=i)
    t = up.KeyedTable(spark, tmp_dir, ["time", "id"], partition_col="time").read()
    assert dict(t.dtypes)["time"] == "string" and t.count() == 6
    assert len(list_folder(spark, f"{tmp_dir}/data")) <= up.KeyedTable.KEPT_VERSIONS
    assert len(list_folder(spark, f"{tmp_dir}/manifests")) <= up.KeyedTable.KEPT_VERSIONS


def test_keyed_table_versioned_replace(spark, tmp_dir):
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=4)
    late = spark.createDataFrame([(1, "new", 2.0)], SCHEMA)
    early = spark.createDataFrame([(1, "old", 1.0)], SCHEMA)
    t.upsert(late, order=["bal"], batch_id=0, whole_row=True)
    t.upsert(early, order=["bal"], batch_id=1, whole_row=True)   # older version arrives later
    assert rows(t.read()) == [(1, "new", 2.0)]


def test_daily_snapshot(spark, tmp_dir):
    b = spark.createDataFrame([("2024-01-01", 1, 5.0, 1), ("2024-01-01", 1, 6.0, 2), ("2024-01-02", 1, 7.0, 1)],
                              "time string, id long, qty double, seq int")
    s1 = up.snapshot_merge(None, b, ["seq"])
    assert rows(s1.select("key", "qty")) == [("2024-01-01_1", 6.0), ("2024-01-02_1", 7.0)]
    rerun = spark.createDataFrame([("2024-01-02", 1, 9.0, 1)], "time string, id long, qty double, seq int")
    s2 = up.snapshot_merge(s1, rerun, ["seq"])
    assert rows(s2.select("key", "qty")) == [("2024-01-01_1", 6.0), ("2024-01-02_1", 9.0)]
    up.write_daily_snapshot(spark, tmp_dir, b, ["seq"])
    up.write_daily_snapshot(spark, tmp_dir, rerun, ["seq"])
    got = up.KeyedTable(spark, tmp_dir, ["time", "id"], partition_col="time").read()
    assert rows(got.select("key", "qty")) == [("2024-01-01_1", 6.0), ("2024-01-02_1", 9.0)]


def test_ensure_table(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType())])
    up.ensure_table(spark, tmp_dir, schema)
    spark.createDataFrame([(1,)], schema).write.mode("append").parquet(tmp_dir)
    up.ensure_table(spark, tmp_dir, schema)         # exists: untouched
    assert spark.read.parquet(tmp_dir).count() == 1


def test_merge_idempotence_property(spark):
    import random
    rnd = random.Random(5)
    for _ in range(5):
        t_rows = {k: (f"n{k}", float(k)) for k in rnd.sample(range(30), 12)}
        u_rows = [(k, rnd.choice([None, f"u{k}"]), rnd.choice([None, float(-k)]), rnd.randint(0, 3))
                  for k in [rnd.randrange(40) for _ in range(15)]]
        t = spark.createDataFrame([(k, n, b) for k, (n, b) in t_rows.items()], SCHEMA)
        u = spark.createDataFrame(u_rows, SCHEMA + ", seq int")
        once = up.merge_upsert(t, u, "id", order=["seq"])
        twice = up.merge_upsert(once, u, "id", order=["seq"])
        assert rows(once) == rows(twice)
        keys = {r[0] for r in rows(once)}
        assert keys == set(t_rows) | {k for k, *_ in u_rows}


def test_a_small_batch_writes_its_own_rows_only(spark, tmp_dir):
    """500 of 20,000 keys: the batch is laid over the table; many batches later the layers are written anew."""
    from reviewlake.session import list_folder
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=4)
    t.upsert(spark.range(20_000).selectExpr("id", "concat('n', id) AS name", "double(id) AS bal", "0 AS at"), arrival=["at"])
    want = {i: (f"n{i}", float(i)) for i in range(20_000)}

    def written():
        newest = max(list_folder(spark, f"{tmp_dir}/data"))
        return spark.read.parquet(f"{tmp_dir}/data/{newest}").count()
    counts = []
    for b in range(1, 14):
        rows = spark.range(500).selectExpr(f"id * {b + 1} AS id", f"IF(id % 2 = 0, 'b{b}', NULL) AS name", f"IF(id % 3 = 0, {b}D, NULL) AS bal", "0 AS at")
        t.upsert(rows, arrival=["at"], batch_id=b, query="q")
        for i in range(500):
            name, bal = want[i * (b + 1)]
            want[i * (b + 1)] = (f"b{b}" if i % 2 == 0 else name, float(b) if i % 3 == 0 else bal)
        counts.append(written())
    assert {r.id: (r.name, r.bal) for r in t.read().collect()} == want
    assert counts[0] == 500 and sorted(counts)[len(counts) // 2] == 500 and max(counts) >= 20_000 / 4
    assert all(len(p["layers"]) <= up.KeyedTable.MAX_LAYERS for p in t._manifest()["parts"].values())


def test_layers_of_whole_rows_keep_the_newer_version(spark, tmp_dir):
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=1)
    t.upsert(spark.range(100).selectExpr("id", "'base' AS name", "10D AS bal"), order=["bal"], whole_row=True)
    t.upsert(spark.createDataFrame([(1, "older", 5.0), (2, "newer", 11.0), (200, "more", 1.0)], SCHEMA), order=["bal"], whole_row=True)
    t.upsert(spark.createDataFrame([(2, "late", 10.5), (3, "newer", 12.0)], SCHEMA), order=["bal"], whole_row=True)
    assert len(t._manifest()["parts"]["0"]["layers"]) == 3
    got = {r.id: r.name for r in t.read().collect()}
    assert (got[1], got[2], got[3], got[200], len(got)) == ("base", "newer", "newer", "more", 101)
    t.upsert(spark.createDataFrame([(1, None, 77.0, 0), (500, "x", 1.0, 0)], SCHEMA + ", at int"), arrival=["at"])     # by column now
    assert len(t._manifest()["parts"]["0"]["layers"]) == 1
    got = {r.id: (r.name, r.bal) for r in t.read().collect()}
    assert got[1] == ("base", 77.0) and got[2] == ("newer", 11.0) and got[500] == ("x", 1.0) and len(got) == 102


def test_new_columns_and_an_empty_first_batch(spark, tmp_dir):
    t = up.KeyedTable(spark, tmp_dir, "id", buckets=2)
    first = spark.createDataFrame([(1, "a", 1.0, 0)], SCHEMA + ", at int")
    t.upsert(first.where("false"), arrival=["at"])
    assert t.read().count() == 0
    t.upsert(first, arrival=["at"])
    t.upsert(spark.createDataFrame([(1, "extra", 1), (2, "extra", 1)], "id long, more string, at int"), arrival=["at"])
    assert sorted(tuple(r) for r in t.read().select("id", "name", "more").collect()) == [(1, "a", "extra"), (2, None, "extra")]


def test_one_day_is_written_by_many_tasks(spark, tmp_dir):
    from reviewlake.session import list_folder
    day = spark.range(30_000).selectExpr("'2024-01-01' AS time", "id", "id AS qty", "1 AS seq")
    t = up.KeyedTable(spark, tmp_dir, ["time", "id"], partition_col="time", file_rows=5_000)
    t.upsert(day, order=["seq"], batch_id=0)
    version, = list_folder(spark, f"{tmp_dir}/data")
    files = [f for f in list_folder(spark, f"{tmp_dir}/data/{version}/_part=2024-01-01") if f.startswith("part-")]
    assert 3 <= len(files) <= 6 and t.read().count() == 30_000
