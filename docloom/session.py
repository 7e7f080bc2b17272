"""Session helpers: a local session for tests, and tables staged in the cluster's shared folder.

Multi-step operators cut lineage by writing a table to the folder named in ``spark.checkpoint.dir``
and reading it again. A lost executor then costs no more than the step at work, and the shuffle
files of a finished step can be removed at once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it. Only a session whose
    executors are threads of this process may do without: it gets a folder of its own. On a cluster an unset
    name is an error."""
    found = spark.conf.get(CHECKPOINT_KEY, None)
    if found:
        return found.rstrip("/")
    master, app = spark.conf.get("spark.master", ""), spark.conf.get("spark.app.id", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that the driver and all executors share")
    if app not in _local_dirs:
        _local_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _local_dirs[app]


class Staged:
    """A table written to the shared folder; ``df`` reads it, ``drop()`` removes it. What is not dropped, or is left by a
    failed write, goes when the application ends. ``batch_rows`` bounds the Arrow batches of the write, for rows
    that are large in memory."""

    def __init__(self, df: DataFrame, label: str, batch_rows: int | None = None):
        spark = df.sparkSession
        self.spark, self.path = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        wanted = {SHUFFLE_CLEANUP_KEY: "true"} | ({BATCH_ROWS_KEY: str(batch_rows)} if batch_rows else {})
        before = {key: spark.conf.get(key, None) for key in wanted}
        try:
            for key, value in wanted.items():
                spark.conf.set(key, value)
            df.write.option("compression", "zstd").parquet(self.path)
        finally:
            folder, files = self._folder()
            files.deleteOnExit(folder)
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def _folder(self) -> tuple:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def size(self) -> int:
        """Bytes of the files."""
        folder, files = self._folder()
        return int(files.getContentSummary(folder).getLength())

    def drop(self) -> None:
        """Remove the files; only once no later step reads them."""
        folder, files = self._folder()
        files.delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
