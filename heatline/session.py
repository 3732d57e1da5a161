"""Session settings and durable intermediate results."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SPREAD_BYTES = 64 << 20
_shipped = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name="heatline", master=None, shuffle_partitions=None, **extra) -> SparkSession:
    """A session with the settings every job here expects.

    On a cluster leave `master` to spark-submit. `shuffle_partitions` is only the number AQE starts
    from; it merges small partitions afterwards, so set it high for large inputs.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the Python workers, once per application.

    Workers need not share the driver's folders; Spark serves the archive to them. Nothing to do
    where the package already came as an archive (`--py-files`).
    """
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if context.applicationId not in _shipped and os.path.isdir(package):
        path = os.path.join(tempfile.mkdtemp(prefix="heatline-code-"), "heatline.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    return spark


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: truncation to hours and days must not depend on where a job runs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only for a local master without any."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "heatline-checkpoints")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, for tables a job writes and reads back."""
    return f"{shared_folder(spark).rstrip('/')}/heatline-{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this job's own tables, wherever Spark can write."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder wherever Spark can read; none where it does not exist."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def scanned_bytes(df: DataFrame) -> int:
    """Bytes on disk of the files that a frame reads, from the file index; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    plans = [leaves.apply(k) for k in range(leaves.size())]
    return sum(int(p.relation().sizeInBytes()) for p in plans if p.getClass().getSimpleName() == "LogicalRelation")


def spread(df: DataFrame, key: str, per_core=SPREAD_BYTES) -> DataFrame:
    """Rows dealt over all cores where the input is too small to give each of them a task.

    Meant before costly work on text. A row group is one task, however many splits it is cut into, so
    files count by their bytes: they are dealt anew where there are fewer of them than cores and they
    hold less than `per_core` bytes a core, so what moves is small. A larger input has row groups enough
    and is left as it is. Other frames are dealt only where they are one partition.
    """
    cores, size = df.sparkSession.sparkContext.defaultParallelism, scanned_bytes(df)
    small = size < per_core * cores and len(df.inputFiles()) < cores if size else df.rdd.getNumPartitions() < 2
    return df.repartition(cores, key) if small else df


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once, durably, for several readers.

    Used where a raw table has been reduced to a small one (hourly sums) that the following steps
    read several times: the raw scan then runs once, and a lost executor costs no recomputation.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
