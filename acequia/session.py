"""Session settings that the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE sizes and splits the shuffle partitions at run time, so one setting serves
# a laptop and a large cluster: start high, coalesce small, split skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "acequia", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    A session in one process (master `local…`) without that setting gets a folder
    made here; on a cluster the setting is required, since executors and driver
    share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="acequia-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; options go to the writer.

    Later steps then neither repeat its work nor depend on executors that may be
    lost, and Spark knows its true size. The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete the files of frames from `materialize` that nothing reads any more, so that disk does not fill with finished steps.

    Frames that still depend on them can no longer be computed: what follows must be stored first.
    """
    for df in stored:
        spark = df.sparkSession
        base = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        files = base.getFileSystem(spark._jsc.hadoopConfiguration())
        root = files.makeQualified(base)
        for file in df.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if not files.makeQualified(folder.getParent()).equals(root):
                raise ValueError(f"not stored by materialize: {file}")
            files.delete(folder, True)
