"""Session and scratch-location helpers.

On a cluster, ``spark.checkpoint.dir`` names a shared, fault-tolerant folder (HDFS / object store).
Everything this library materialises (checkpoints, staged upserts, stream checkpoints, landed test
messages) goes below it. A local temporary folder is only chosen when the setting is absent, which
happens in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str = "local[*]", app: str = "reviewlake", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Builder used by tests and the bench; a cluster job passes its own session instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get(SPREAD_CONF, None) is None:
        spark.conf.set(SPREAD_CONF, str(spark.sparkContext.defaultParallelism))
    ensure_checkpoint_dir(spark)
    return spark


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def state_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose streams keep their state in RocksDB, which timers and time-to-live need.
    The caller's session stays as it is; both share the application."""
    if spark.conf.get(STATE_STORE[0], None) == STATE_STORE[1]:
        return spark
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(*STATE_STORE)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Only a session in one process may go without the setting (as in
    tests); it then uses a local temporary folder. On a cluster that would scatter files over machines."""
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="reviewlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system for the path (which may have no scheme) and the path in it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder. Other storage errors are raised."""
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/reviewlake/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` once as Parquet below the shared checkpoint folder and read it back.

    Used for intermediates consumed several times (a count plus both sides of a blocked join):
    computed once, survives executor loss, and the re-read plan has file statistics. (An eager
    ``checkpoint()`` would compute the plan twice unless cached; ``localCheckpoint`` is not
    fault tolerant.)
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Number of partitions that a local session asks CPU-heavy row work to be spread over (see ``spread``).
SPREAD_CONF = "reviewlake.spreadPartitions"


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread CPU-heavy row work over the number of partitions the session asks for, if it asks.

    Tests and the bench do, as their tables are single files with one row group, read by one task. A
    cluster job doesn't: its scans have many partitions, and its plans get no extra shuffle.

    After the shuffle the rows pass through a one-element ``inline`` generator: Catalyst does not
    push filters through it, so a filter on a cleaned column runs after the shuffle, in parallel.
    """
    target = int(df.sparkSession.conf.get(SPREAD_CONF, "0"))
    if not target:
        return df
    r = df.repartition(target, key) if key else df.repartition(target)
    return r.select(F.inline(F.array(F.struct(*[F.col(c) for c in r.columns]))))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reviewlake`` importable on executors (what ``--py-files`` does), once per application.

    The Python task functions (block k-NN, block TF-IDF products, lexicon tokeniser) live in this
    package; Spark distributes the zip to every executor with ``addPyFile``.
    """
    import os
    import zipfile

    import reviewlake

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(reviewlake.__file__))
    with tempfile.TemporaryDirectory(prefix="reviewlake-py-") as folder:
        local = f"{folder}/reviewlake.zip"
        with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _dirs, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        fs, target = _file_system(spark, f"{ensure_checkpoint_dir(spark)}/reviewlake-pyfiles/{sc.applicationId}/reviewlake.zip")
        fs.mkdirs(target.getParent())
        fs.copyFromLocalFile(False, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), target)
        target = fs.makeQualified(target).toString()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
