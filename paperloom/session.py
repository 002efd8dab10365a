"""Session helpers: checkpoint folder, bounded collects, table access."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once per application: their Python need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="paperloom-"), "paperloom_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder that the session names; a machine-local one only in local mode (tests): on a cluster it must be named."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local") or sc.master.startswith("local-cluster") and not named:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="paperloom-ckpt-"))


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size is proven bounded; raise where the proof fails."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; raise the documented bound")
    return rows


SPREAD_BELOW = 1 << 30


def spread(df: DataFrame, below: int = SPREAD_BELOW) -> DataFrame:
    """A scan of few, small files dealt out to all cores; for work that costs far more than moving its rows.

    A file may be one row group and then is one task, however the splits are set.  Inputs of ``below`` bytes and more (0: all), and those
    of many files, stay as they are; the rows are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= below or len(df.inputFiles()) >= 2 * cores:
        return df
    return df.repartition(2 * cores)


def wide(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, spread."""
    t = table(spark, sf_dir, name)
    return spread(t.select(*columns) if columns else t)
