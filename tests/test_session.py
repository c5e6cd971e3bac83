"""Session helpers: shared checkpoint folder, lineage cut by written Parquet, package shipping."""

from pyspark.sql import functions as F

from reviewlake import session


def test_checkpoint_dir_is_read_from_session(spark):
    d = session.ensure_checkpoint_dir(spark)
    assert d and spark.conf.get(session.CHECKPOINT_CONF).rstrip("/") == d
    assert session.scratch_path(spark, "x").startswith(d + "/reviewlake/x-")


def test_cut_lineage_materialises_once(spark):
    df = spark.range(100).withColumn("r", F.col("id") * 2)
    cut = session.cut_lineage(df, "t")
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cut.explain()
    assert "Scan parquet" in buf.getvalue() and "Range" not in buf.getvalue()


def test_ship_package_is_idempotent(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
