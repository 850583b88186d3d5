"""What the operators need from the running session: a shared folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table must fit in every executor next to its work.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a temporary folder; on a cluster that
    would be machine-local, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="skyweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_folder(spark)}/skyweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


# Hadoop starts a process for the permissions of each file it makes on a local disk, and one for those of its
# checksum file. Parquet written as small files does without the second; other file systems ignore this.
PLAIN_LOCAL_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_by_cores(spark: SparkSession) -> None:
    """Let the session deal the listing of folders over a few tasks for each core; Spark would start one for every folder."""
    most = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING_TASKS)) > most:
        spark.conf.set(_LISTING_TASKS, str(most))


def read_folders(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Parquet of many folders, listed now."""
    list_by_cores(spark)
    return spark.read.schema(schema).parquet(path)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` fits in ``max_bytes``, by its counted rows and the lengths of its strings.

    A value takes at most 16 bytes besides the text of a string. Frames that hold nested types
    are not measured and do not fit.
    """
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields):
        return False
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{name}`"))), F.lit(0)) for name in texts]
    size = F.count(F.lit(1)) * F.lit(16 + 16 * len(df.columns)).cast("long")
    for length in lengths:
        size = size + length
    return df.agg(size.alias("bytes")).first()["bytes"] <= max_bytes


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its counted rows fit in ``max_bytes``.

    Beyond the bound the frame comes back without a hint and Spark joins by shuffle, where
    adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
