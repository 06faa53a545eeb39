"""Where jobs keep what must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``. Without that setting only a local master
    gets a temporary folder; a cluster has to name a shared one."""
    path = spark.conf.get(_DIR, None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_DIR} to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="coppice-"))
    return spark.sparkContext.getCheckpointDir()


ADAPTIVE = "spark.sql.adaptive.enabled"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
CACHE_ROWS = "spark.sql.inMemoryColumnarStorage.batchSize"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def own_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, which can be changed for its tables alone."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def persisted(df: DataFrame, rows: int) -> DataFrame:
    """The table, persisted with ``rows`` rows in a batch. Java's serializer holds on to the last 100 batches
    that it has written or read of a partition, and by itself Spark fills each with 4 MB of wide rows."""
    conf = df.sparkSession.conf
    usual = conf.get(CACHE_ROWS)
    conf.set(CACHE_ROWS, rows)
    try:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        conf.set(CACHE_ROWS, usual)


def new_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """Unused path below the shared folder, or below another one."""
    return f"{folder or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None, **options: str) -> tuple[DataFrame, str]:
    """The table written below the shared (or another) folder and read back from there, with its path.
    What follows starts from these files: nothing before them is computed again when
    executors are lost, and the query plan is short again."""
    path = new_path(df.sparkSession, name, folder)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`written` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
