"""Session set-up and the shared folder for files that must outlive an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app_name: str = "notewright", **settings: str) -> SparkSession:
    """Session with the settings this library is tuned for. Extra settings use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; where none is set, one in the warehouse, which all executors see.

    A warehouse on the driver's own disk will do only where everything runs in one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/notewright-shared"
        if folder.startswith(("file:", "/")) and not context.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    if not context.getCheckpointDir():  # checkpoint() looks nowhere else
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/notewright/{name}-{uuid.uuid4().hex}"


def materialised(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, for results that are read several times."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for large results of which later steps read few columns."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def small_batches(spark: SparkSession, most: str = "4m") -> None:
    """Have Arrow batches of texts hold ``most`` bytes at once, for the session where nothing else is set.

    Spark counts rows alone otherwise, and 10,000 texts take several times their size in the executor and once more in its Python worker.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, most)


class Scratch:
    """Tables of one computation in the shared folder. Shuffles end with the write they served, tables when they are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def stored(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame as a table, like ``stored``."""
        path = scratch_path(self.spark, name)
        before = self.spark.conf.get(_FREE_SHUFFLES, None)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            frame.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_FREE_SHUFFLES)
            else:
                self.spark.conf.set(_FREE_SHUFFLES, before)
        table = self.spark.read.parquet(path)
        self._paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            _, path = self._paths.pop(id(table))
            path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
