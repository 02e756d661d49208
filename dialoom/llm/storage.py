"""Tables and scratch space that every executor can reach.

Intermediate results are written as Parquet below ``spark.checkpoint.dir``: this cuts lineage, survives lost
executors and leaves a file that can be read again. Nothing here touches a machine-local folder on a cluster.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCRATCH = "dialoom-scratch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where it is unset: a temporary folder if the session is a
    single process (tests), else a folder of the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        root = "file://" + tempfile.mkdtemp(prefix="dialoom-")
    else:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/" + SCRATCH
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs in here leave no shuffle files: what they made is in the table that they wrote."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


class Scratch:
    """One folder of intermediate tables. ``save`` writes and rereads a frame, ``drop`` removes a table that was
    superseded, ``close`` removes all of them, once nothing reads the results that were built on them."""

    open_ones: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_root(spark)}/{SCRATCH}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        Scratch.open_ones.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        at = f"{self.path}/{self.count:03d}-{name}"
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out.scratch_path = at
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            delete_path(self.spark, df.scratch_path)

    def close(self) -> None:
        delete_path(self.spark, self.path)


def release_all(since: int = 0) -> None:
    """Close the scratch folders opened after the first ``since`` ones."""
    while len(Scratch.open_ones) > since:
        Scratch.open_ones.pop().close()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def literal_table(values: list[float]) -> Column:
    """An array of doubles that the optimizer folds into one literal: looked up in constant time, shipped with the plan."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def pinned(column: Column) -> Column:
    """The same values, as a column that the optimizer neither inlines nor moves filters below. Otherwise a filter on a
    column made of arrays, or the one that explode() implies, brings the arrays' expressions into each other's loops."""
    return F.when(F.monotonically_increasing_id() >= 0, column)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
