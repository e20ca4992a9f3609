"""Tables written between steps, deleted when their scope ends."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which the driver and all executors share.

    Only a session on one machine may leave that unset; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="hiatus-")


class Workspace:
    """Written tables that live as long as a ``with`` block.

    A written table survives lost executors, unlike persisted blocks, and later steps
    see its true size. At the end of the block every table is overwritten by one
    without rows, which frees its files through Spark's own writer on any file
    system; an empty file stays. Frames that read a table must be used inside the block.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or shared_folder(spark)).rstrip("/")
        self.paths: list[str] = []

    def write(self, frame: DataFrame, label: str = "table") -> DataFrame:
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        self.paths.append(path)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self) -> None:
        nothing = self.spark.range(0).coalesce(1)
        while self.paths:
            nothing.write.mode("overwrite").parquet(self.paths.pop())

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
