"""Session helpers shared by the whole engine."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """The package, sent to the Python workers once for each application, wherever the session was started."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sievework-code-")) / "sievework_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(here.rglob("*.py")):
            z.write(source, source.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a data directory."""
    ship_code(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    A cluster names it in ``spark.checkpoint.dir``; only on a local master a folder is set here where that is unset. On
    any other master an unset folder is an error, as no folder of one machine would do.
    """
    context = spark.sparkContext
    there = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    if not there:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        there = tempfile.mkdtemp(prefix="sievework-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(there)
    return there


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written once to the shared folder, so that later reads neither recompute it nor need its executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def parallelism(df: DataFrame, least: int = 1) -> int:
    """Slots of the session; what to spread a few large rows over."""
    return max(least, df.sparkSession.sparkContext.defaultParallelism)


@dataclass
class Table:
    """A table in the shared folder."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        """Its files go; for tables that nothing reads any more."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> Table:
    """``df`` as a table in the shared folder. The shuffle files of the plan are removed with the end of the write, not when the
    driver happens to collect its garbage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return Table(spark.read.schema(df.schema).parquet(path), path)
