"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime settings the library relies on; all may be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "roadspeed", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may do without it; then the session gets a fresh temporary checkpoint
    folder, made once.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="roadspeed-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder; nothing exists there yet."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def spread_tasks(spark: SparkSession) -> int:
    """Tasks for work whose size its input bytes do not show, such as generated rows or archives.

    Adaptive execution would merge such tasks, so their number is fixed: at least one per core.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a written Parquet table that survives lost executors.

    Unlike a cached frame the table keeps column pruning and filter pushdown for later passes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run below the shared folder; ``release`` removes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def materialise(self, df: DataFrame, label: str) -> DataFrame:
        """As the function of this name, and remembered."""
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Remove the tables; frames that read them fail from then on."""
        while self.paths:
            remove_path(self.spark, self.paths.pop())

    def size(self) -> int:
        """Bytes that the tables hold."""
        total = 0
        for path in self.paths:
            place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            store = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            total += store.getContentSummary(place).getLength()
        return total


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark resolves it; for use inside tasks."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(place).toString()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that fits a glob, exists."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return bool(found)
