"""Sources, codec, reshaping and sinks on hand-made rows (FIXTURES C)."""

import json
import os

from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import codec, misc
from reviewlake.operators import reshape, sampling, sinks
from reviewlake.sources import files


def test_codec_roundtrip(spark):
    import struct
    rows = [(struct.pack("!i", -7), struct.pack("!q", -(2 ** 40)), struct.pack("!f", 4.3), struct.pack("!?", True),
             "Tiếng Việt".encode()),
            (struct.pack("!i", 2 ** 31 - 1), struct.pack("!q", 5), struct.pack("!f", -0.0), struct.pack("!?", False),
             b""),
            (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "i binary, q binary, f binary, b binary, s binary")
    out = codec.decode_cells(df, {"i": "int", "q": "long", "f": "float", "b": "bool", "s": "string"}).collect()
    assert out[0]["i"] == -7 and out[0]["q"] == -(2 ** 40) and out[0]["b"] is True and out[0]["s"] == "Tiếng Việt"
    assert out[0]["f"] == struct.unpack("!f", struct.pack("!f", 4.3))[0]       # 4.300000190734863
    assert out[1]["i"] == 2 ** 31 - 1 and out[1]["q"] == 5 and out[1]["b"] is False and out[1]["f"] == 0.0
    assert all(v is None for v in out[2])
    enc = spark.range(1).select(codec.encode_int(F.lit(-7)).alias("x")).collect()[0]["x"]
    assert bytes(enc) == struct.pack("!i", -7)


def test_decode_key(spark):
    import struct
    df = spark.createDataFrame([(struct.pack("!i", 263487037),), (b"123456",)], "k binary")
    assert [r[0] for r in df.select(reshape.decode_key("k")).collect()] == [263487037, 123456]


def test_review_payload_and_null_author(spark, tmp_dir):
    recs = [
        {"id": 1, "rating": 5, "created_by": {"id": 10, "purchased_at": None}},
        {"id": 2, "rating": 4},                                   # author missing
        {"id": 3, "rating": 1, "created_by": None},               # author null
        {"id": 4, "rating": 3, "created_by": {"id": None}},       # author id explicit null -> dropped
        {"id": 5, "rating": 2, "created_by": {"name": "x"}},      # author id absent -> stays
    ]
    path = f"{tmp_dir}/reviews"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    raw = files.read_variant(spark, path)
    kept = reshape.drop_null_author(raw)
    ids = sorted(r["id"] for r in kept.selectExpr("variant_get(v, '$.id', 'int') AS id").collect())
    assert ids == [1, 2, 3, 5]
    typed = files.read_payloads(spark, path, schemas.REVIEW)
    norm = {r["id"]: r for r in reshape.normalize_review(typed).collect()}
    assert norm[1]["created_by"]["purchased_at"] == 0 and norm[1]["score"] == 5.0
    assert norm[2]["created_by"]["id"] == 0 and norm[3]["created_by"]["id"] == 0
    assert norm[5]["created_by"]["id"] == 0 and norm[5]["created_by"]["name"] == "x" and norm[2]["images"] == []


def test_product_json_and_specs(spark, tmp_dir):
    prod = {"id": 7, "name": "Áo", "price": 10, "brand": None, "all_time_quantity_sold": None,
            "specifications": [{"name": "Chung", "attributes": [{"code": "a", "value": "<b>x</b>\\n"},
                                                                {"code": "a", "value": "y"}]}],
            "categories": {"id": 3, "name": "c"}, "images": None}
    path = f"{tmp_dir}/products"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/p.json", "w") as f:
        f.write(json.dumps(prod) + "\nnot json\n")
    df = files.read_products(spark, path, schemas.PRODUCT)
    assert df.count() == 1
    df = reshape.default_struct(df, "brand", {"id": 0, "name": "", "slug": ""})
    df = reshape.zero_if_null(df, "all_time_quantity_sold")
    df = reshape.stamp_parent(df, F.lit(1).cast("long"), F.lit("root"))
    df = reshape.stamp_date(df, "2024-05-01")
    df = reshape.snapshot_key(df)
    r = df.collect()[0]
    assert r["brand"]["id"] == 0 and r["all_time_quantity_sold"] == 0 and r["categories"]["parent_name"] == "root"
    assert r["key"] == "2024-05-01_7"
    specs = reshape.explode_specs(df).collect()[0]["specs"]
    assert specs == {"Chung:a": "y"}                # a repeated (spec, attr) keeps the last value


def test_pages_and_images(spark):
    df = spark.createDataFrame([(1, 3), (2, 0)], "id long, last int")
    assert sorted((r["id"], r["page"]) for r in reshape.enumerate_pages(df, 1, "last").collect()) == [
        (1, 1), (1, 2), (1, 3)]
    im = spark.createDataFrame([(1, [(5, "p", "ok"), (6, "q", "ok")])],
                               "id long, images array<struct<id:long,full_path:string,status:string>>")
    assert [(r["idx"], r["full_path"]) for r in reshape.explode_images(im).collect()] == [(0, "p"), (1, "q")]


def test_messages(spark):
    df = spark.createDataFrame([(1, "Nhà sách"), (2, None)], "id long, name string")
    msg = sinks.to_message(df).collect()
    assert json.loads(msg[1]["value"]) == {"id": 2, "name": None}
    t = df.select(misc.to_tuple_message("id", "name").alias("m"))
    id_, name = misc.parse_tuple_message("m")
    assert t.select(id_, name).collect()[0][1] == "Nhà sách"
    bad = spark.createDataFrame([("(1, x)",)], "m string")
    id_, name = misc.parse_tuple_message("m")
    assert bad.select(id_, name).collect()[0] == (None, None)


def test_csv_roundtrip_and_conform(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'say "hi"\nline2', "True"), (2, "x,y", "no")], "id long, text string, is_leaf string")
    sinks.export_csv(df, f"{tmp_dir}/csv")
    back = files.read_csv_strings(spark, f"{tmp_dir}/csv", multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == [("1", 'say "hi"\nline2', "True"), ("2", "x,y", "no")]
    prod = files.read_product_csv(spark, f"{tmp_dir}/csv", types={"id": "long"})
    assert sorted((r["id"], r["is_leaf"]) for r in prod.collect()) == [(1, True), (2, False)]
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()),
                           T.StructField("extra", T.DoubleType())])
    c = sinks.conform(back, schema)
    assert c.columns == ["id", "text", "extra"]
    rej = sinks.conform_rejects(back.withColumn("id", F.when(F.col("id") == "2", "zz").otherwise(F.col("id"))), schema)
    assert rej.collect()[0]["id"] == 1


def test_wordlist(spark, tmp_dir):
    path = f"{tmp_dir}/words.txt"
    os.makedirs(tmp_dir, exist_ok=True)
    with open(path, "w") as f:
        f.write("a_b\n  c \n\nc\n")
    assert sorted(r["word"] for r in files.read_wordlist(spark, path).collect()) == ["a_b", "c"]


def test_random_backfill(spark):
    df = spark.range(10000).withColumn("fav", F.lit(0))
    a = sampling.random_backfill(df, "id", "fav", 1, 19584, draws=9737, seed=1)
    b = sampling.random_backfill(df.repartition(7), "id", "fav", 1, 19584, draws=9737, seed=1)
    assert sorted(a.collect()) == sorted(b.collect())
    hit = a.filter("fav > 0").count()
    assert abs(hit - 10000 * sampling.hit_fraction(9737, 10000)) < 300
    assert a.agg(F.min("fav"), F.max("fav")).collect()[0][0] >= 0


def test_rows_and_small_helpers(spark):
    from reviewlake.sources.tables import from_rows, lookup, scan
    df = from_rows(spark, [(3, "c"), (1, "a"), (2, "b")], "id long, name string")
    assert \
        [r["name"] for r in scan(df, ["name"], key="id", limit=2).collect()] == ["a", "b"]
    assert [r["id"] for r in scan(df, key="id", start=2).orderBy("id").collect()] == [2, 3]
    keys = from_rows(spark, [(2,), (2,), (9,)], "id long")
    assert [r["id"] for r in lookup(df, keys, "id", max_broadcast_rows=10).collect()] == [2]
    arr = spark.createDataFrame([(["x", "y"], "2024-01-02 10:00:00"), ([], None)], "t array<string>, ts string")
    got = arr.select(misc.n_tokens("t").alias("n"), misc.first_token("t").alias("f"),
                     misc.day(F.col("ts").cast("timestamp")).alias("d")).collect()
    assert tuple(got[0]) == (2, "x", "2024-01-02") and tuple(got[1]) == (0, None, None)


def test_append_and_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    sinks.append(df, f"{tmp_dir}/t")
    sinks.append(df, f"{tmp_dir}/t")                 # no key: a re-run appends again
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2
    sinks.overwrite(df, f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1
