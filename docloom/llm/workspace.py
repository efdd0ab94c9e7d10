"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Shuffle files go as soon as the table that they were for is written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a narrow table (ids, keys, hashes) up to which it is sent to all executors; a count comes first, and beyond it both sides are shuffled.
SENT_ROWS = 300_000
#: Tables written until the driver's JVM collects its garbage: a table sent to the executors, a megabyte at least, stays on the driver's heap until then.
COLLECT_EVERY = 12
_written = 0


def sent(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """A narrow table as the smaller side of a join: to all executors if a count finds it small, else shuffled like the other side."""
    return F.broadcast(rows) if rows.count() <= (SENT_ROWS if limit is None else limit) else rows


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where that is unset, as in tests, a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


class Workspace:
    """Written tables cut lineage, so that a lost executor costs a re-read and not a recomputation."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self._remove, self.path)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        global _written
        _written += 1
        if _written % COLLECT_EVERY == 0:
            self.spark.sparkContext._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._docloom_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in tables:
            self._remove(df._docloom_path)

    def _remove(self, path: str) -> None:
        _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before
        pass


#: Rows of a batch that a Python worker gets; texts of a few thousand characters make up some megabytes then.
_BATCH, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once for each Spark context, and bound their batches, unless the session has a bound of its own."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":  # Spark's default
        spark.conf.set(_BATCH, _BATCH_ROWS)
    if getattr(context, "_docloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    folder = f"{shared_dir(spark)}/package-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, folder)
    target = f"{folder}/docloom_package.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(buffer.getvalue())
    finally:
        stream.close()
    context.addPyFile(target)
    context._docloom_shipped = True


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows, those with the smallest hashes of a column, all if there are fewer.

    Only rows below a threshold of twice the share are sorted, so that tasks send a few rows each, however many there are.
    """
    total = df.count()
    if total > 4 * n:
        bound = int((1 << 30) * 2 * n / total) + 64
        df = df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < bound)
    return df.orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key).limit(n)
