"""Where intermediate tables go: storage that driver and executors share, and how long they stay."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_OPEN: list[Scratch] = []  # scopes open now, innermost last


def shared_folder(spark: SparkSession, name: str = "table") -> str:
    """Path of a new folder below ``spark.checkpoint.dir``, as the cluster names it.

    Where that is unset, as in tests, the session's warehouse directory is taken. A session
    on a cluster without either of them stops here instead of writing to local disks.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not base or not local:
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = f"{base.rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/pairlore-{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> bool:
    """Delete ``folder`` and all below it on its file system; False where it was not there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.delete(path, True))


class Scratch:
    """The scratch tables of one job, deleted together when the job is done with them.

    ``with Scratch(spark) as scope:`` opens a scope; every table written by ``saved`` inside
    it, also by operators that know nothing of the scope, belongs to the innermost one. Tables
    written by ``scope.result`` stay. When the block ends, normally or by an error, all other
    folders of the scope are deleted, so peak disk is the sum of the scope's tables and after
    the job only its result remains. DataFrames that read a deleted table must not be used
    after the block: take the result from ``scope.result``. Inside another scope the result
    belongs to that one, so a job of several steps holds the tables of one step at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def saved(self, df: DataFrame, name: str = "table") -> DataFrame:
        folder = shared_folder(self.spark, name)
        self.folders.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """``df`` written to a folder that outlives the scope, and read from there."""
        folder = shared_folder(self.spark, name)
        outer = _OPEN[: _OPEN.index(self)] if self in _OPEN else []
        if outer:
            outer[-1].folders.append(folder)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def close(self) -> None:
        while self.folders:
            remove(self.spark, self.folders.pop())

    def __enter__(self) -> Scratch:
        _OPEN.append(self)
        return self

    def __exit__(self, *exc) -> None:
        _OPEN.remove(self)
        self.close()


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to shared storage and read back: its lineage ends here.

    Inside an open ``Scratch`` scope the table is deleted when the scope ends; outside any
    scope it stays, as the caller may read it at any later time.
    """
    if _OPEN:
        return _OPEN[-1].saved(df, name)
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
