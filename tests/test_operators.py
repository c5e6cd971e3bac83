"""Filters, joins and aggregations on hand-made rows."""

from pyspark.sql import functions as F

from reviewlake.operators import aggs, filters, joins


def test_filters(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 10, "c"), (4, 30, None)], "o long, k long, n string")
    assert [r["o"] for r in filters.resume_after(df, "o", "k", 20).collect()] == [2, 3, 4]
    assert filters.resume_after(df, "o", "k", 99).count() == 0                  # unknown cursor -> empty
    assert filters.resume_after(df, "o", "k", None).count() == 4
    assert [r["o"] for r in filters.take_until(df, "o", "k", 20).collect()] == [1, 2]
    assert filters.take_until(df, "o", "k", 99).count() == 4                    # unknown key -> all rows
    assert filters.require(df, ["n"]).count() == 3
    blanks = spark.createDataFrame([(1, None), (2, "  \t"), (3, " x ")], "id int, t string")
    assert [r["id"] for r in filters.drop_blank(blanks, "t").collect()] == [3]
    names = spark.createDataFrame([(5, "blue bolt x"), (3, "red blue bolt"), (9, "z")], "id long, name string")
    assert filters.find_product(names, "name", "blue bolt").collect()[0]["id"] == 3
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id1 long, id2 long")
    assert filters.pairs_of(pairs, 1).collect() == [(1, 2)]
    q = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None)], "name string, q string")
    assert filters.exclude_name(q, "name", "q").count() == 1


def test_joins(spark):
    df = spark.createDataFrame([(1,), (2,)], "product_id long")
    prods = spark.createDataFrame([(1, "x"), (1, "y")], "product_id long, name_product string")
    got = sorted(tuple(r) for r in joins.enrich_name(df, prods).collect())
    assert got == [(1, "y"), (2, None)]                                        # no row multiplication
    d = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "k string, v string, o int")
    base = spark.createDataFrame([("1",), ("3",)], "k string")
    got = sorted(tuple(r) for r in joins.dictionary_join(base, d, "k", "v", "o", "name").collect())
    assert got == [("1", "new"), ("3", "")]
    hist = spark.createDataFrame([(1, "a")], "id long, name string")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b")], "id long, name string")
    assert joins.not_yet_sent(new, hist).collect() == [(1, "b")]
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.range(100).join(joins.broadcast_if_small(spark.range(5), 10), "id").explain()
    assert "BroadcastHashJoin" in buf.getvalue()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.range(100).join(joins.broadcast_if_small(spark.range(50), 10), "id").explain()
    assert "BroadcastHashJoin" not in buf.getvalue() or "AdaptiveSparkPlan" in buf.getvalue()


def test_aggs(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, [""])], "id long, tokens array<string>")
    idf = {r["term"]: (r["df"], r["idf"]) for r in aggs.idf(df, "id", "tokens").collect()}
    import math
    assert idf["a"] == (1, math.log(4 / 2)) and idf["b"] == (2, math.log(4 / 3))
    wf = {r["word"]: r["frequency"] for r in aggs.word_freq(df, "tokens").collect()}
    assert wf == {"a": 2, "b": 2}
    lab = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "l int, p int")
    m = aggs.metrics(lab, "l", "p").collect()[0]
    assert abs(m["accuracy"] - 0.6) < 1e-12 and abs(m["error"] - 0.4) < 1e-12
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    ev = lab.select(F.col("l").cast("double").alias("label"), F.col("p").cast("double").alias("prediction"))
    for name, col in (("f1", "weighted_f1"), ("weightedPrecision", "weighted_precision")):
        v = MulticlassClassificationEvaluator(metricName=name).evaluate(ev)
        assert abs(v - m[col]) < 1e-12
    fc = aggs.filter_counts(lab, F.col("p") == 1).collect()[0]
    assert tuple(fc) == (5, 3)
    last = aggs.last_per_key(spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k int, t int, v string"),
                             "k", ["t"]).collect()
    assert sorted(tuple(r) for r in last) == [(1, 7, "b"), (2, 1, "c")]
