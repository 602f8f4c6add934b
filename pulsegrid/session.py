"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app_name: str = "pulsegrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session for jobs and tests; a cluster launcher normally supplies its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def pin_session(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs rely on.

    The zone changes answers: epoch arithmetic is in UTC. The other lets adaptive execution split a
    hot key of a join even where the result is grouped by that key, at the price of one more shuffle.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") != "true":
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    _size_shuffles(spark)
    return spark


def _size_shuffles(spark: SparkSession) -> None:
    """Start cluster shuffles with many small partitions, which adaptive execution merges by measured
    size; a fixed small number would make the partitions of a large table too large to hold."""
    sc = spark.sparkContext
    if sc.master.startswith("local") or spark.conf.get(INITIAL_PARTITIONS, None):
        return
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * sc.defaultParallelism)
    spark.conf.set(INITIAL_PARTITIONS, str(min(wanted, 65_536)))


def work_root(spark: SparkSession) -> str:
    """Folder shared by all executors: the session's checkpoint folder.

    Only a local session without one gets a temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="pulsegrid-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared work folder."""
    return f"{work_root(spark)}/pulsegrid/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder of any store that Spark reaches; none if it does not exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Store a table in the work folder and read it back: fixed rows, and a size that the planner knows, so
    that a join broadcasts it exactly when its bytes are few."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so later jobs see fixed partitions and rows."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file under its final name at once: readers see all of it or none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    fs = where.getFileSystem(conf)
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    if not fs.rename(draft, where):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file of any store that Spark reaches."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    source = where.getFileSystem(conf).open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
