"""Tables written between the steps of an operator."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_ROOT: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one in ``spark.checkpoint.dir``. Only a session on one machine may
    leave that unset, as tests do; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/hiatus"
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="hiatus-"))
    return _LOCAL_ROOT[0]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """Writes a frame to the shared folder and returns a scan of it.

    Later steps start from files that outlive any executor, see true sizes when
    they choose a join, and find no partitioning of the step before, so that a
    skewed join can still be split. The folder's owner expires the files.
    """
    spark = frame.sparkSession
    path = new_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes a written table that no later step reads.

    Only tables whose readers have all been written in turn may go. Spark has no
    call for this, so it goes through the file system that the path names.
    """
    context = frame.sparkSession.sparkContext
    for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def struct(fields: str) -> T.StructType:
    """A schema from names and simple types, without a session."""
    schema = T.StructType()
    for field in fields.split(", "):
        schema.add(*field.split())
    return schema


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b"").cast("binary"))


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not use."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def levels_for(rows: int, per_leaf: int, most: int) -> int:
    """Depth of a binary tree whose leaves hold about ``per_leaf`` of ``rows``."""
    return min(most, max(0, math.ceil(math.log2(max(rows, 1) / per_leaf))))
