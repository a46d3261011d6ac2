"""Tables that are read more than once, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode without that setting, a temporary folder of this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.TemporaryDirectory(prefix="folioworks-")
    return "file://" + _local[app].name


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written as Parquet and read again: worked out once, and its lineage cut."""
    schema, path = df.schema, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


#: A written side of a join is sent to all executors if its rows have at most so many bytes.
SMALL_SIDE = 32 << 20


def sent(side: DataFrame, n_bytes: Column) -> DataFrame:
    """side marked for a broadcast if its rows are small by n_bytes of each, else side itself."""
    total = side.agg(F.sum(n_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(side) if total <= SMALL_SIDE else side
