"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Every setting is one that holds on a cluster too; sizes of partitions are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # streaming state outside the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "playlens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the folder the cluster shares between its machines.

    ``spark.checkpoint.dir`` names it. Only a session whose tasks all run in this process sets its own; a cluster
    without the setting is an error, since its machines do not share temporary folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="playlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_stage(df, name: str, by: list[str] = []):
    """``df`` written to the shared folder and read back, in folders of the columns ``by``.

    Cuts the lineage of iterative plans; a lost executor re-reads the files instead of losing blocks.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return (spark.read.schema(df.schema) if by else spark.read).parquet(path)  # folders without a row have no files to tell the schema
