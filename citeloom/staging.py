"""Materialised intermediate tables in the folder that the cluster shares.

``spark.checkpoint.dir`` names that folder. Only where it is unset and the master
is local (tests on one machine) a temporary folder is made for the session; on a
cluster an unset folder is an error. Staged tables stay until the caller clears the
folder: results are lazy and may still read them.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or this session's own where none is set."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_KEY} to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="citeloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def staged(df: DataFrame, name: str = "table", by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    The written table cuts lineage and outlives lost executors. ``by`` names its last columns: each of their
    values is a folder of its own, and a filter on them reads only that.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/citeloom-{name}-{uuid.uuid4().hex}"
    w = df.write.option("compression", compression) if compression else df.write
    (w.partitionBy(*by) if by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts and merges: a table that grows with the input must not go through the driver.

    Staged tables of like rows are far smaller as files than as rows, so Spark would broadcast tens of MB of each.
    """
    return df.hint("merge")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any case."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def listed(values: pa.Array) -> list:
    """The values as Python objects, through numpy where it says the same, which takes a fraction of the time."""
    if values.null_count and not pa.types.is_string(values.type):
        return values.to_pylist()
    return values.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(values.type) or pa.types.is_primitive(values.type) and not pa.types.is_temporal(values.type) else values.to_pylist()
