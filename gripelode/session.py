"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task's share is bounded in bytes, so that more rows make more tasks. Texts take many times their bytes once they are read.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Staged files are compressed: what is broadcast is many times their size, in the driver too.
    "spark.sql.autoBroadcastJoinThreshold": "2m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_local: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session options the jobs rely on; all can be changed at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a temporary one, in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local.setdefault(context.applicationId, tempfile.mkdtemp(prefix="gripelode-"))


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    Unlike a cached frame it survives lost executors, and each branch reads only its columns, and with ``by`` only the
    folders of the values that it asks for.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gripelode/{uuid.uuid4().hex}/{name}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop(*frames: DataFrame) -> None:
    """Remove the folders of staged frames that nothing reads any more."""
    for frame in frames:
        if path := getattr(frame, "_staged_at", None):
            delete_folder(frame.sparkSession, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
