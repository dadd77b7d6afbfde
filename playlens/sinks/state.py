"""Keyed state of streams as tables: the least or greatest value of each key, merged batch by batch.

A batch reads only the parts (hash buckets, or days) that its keys lie in, and appends to them the keys whose value it
changed, each batch in a folder of its own: a replayed batch replaces itself. Values merge in any order, so nothing is late.
There is no per-key Python: a batch is one aggregate over its rows and the touched parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens.session import write_stage
from playlens.sinks.deltas import BATCH, _latest_base
from playlens.sinks.tables import exists, folders

PART = "part"
BUCKETS = 64


def bucket(keys: list[str], n: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def write_parts(df: DataFrame, path: str, batch_id: int, part: str = PART) -> None:
    """Append rows to the folders of their parts; the folders of the same batch are replaced.

    Rows of a part meet before they are written, large parts in several tasks, so the files are as many as the parts
    and the data need, not as tasks times parts.
    """
    out = df.hint("rebalance", part).withColumn(BATCH, F.lit(batch_id).cast("long"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part, BATCH).parquet(path)


def read_parts(spark: SparkSession, path: str, schema: str | StructType, part: str, wanted=None) -> DataFrame:
    """Rows of the parts whose folder name ``wanted`` accepts; other folders are not even listed.

    ``schema`` includes the part and the batch. Without any such folder the table is empty.
    """
    names = [name for name in folders(spark, path) if name.startswith(f"{part}=") and (wanted is None or wanted(name.split("=", 1)[1]))]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{name}" for name in names])


def _schema(like: DataFrame, keys: list[str]) -> StructType:
    fields = {f.name: f.dataType for f in like.schema.fields}
    out = StructType()
    for name, source in [*((k, k) for k in keys), ("value", "value"), (PART, PART)]:
        out = out.add(name, fields[source])
    return out.add(BATCH, "long")


def _merge(how: str):
    if how not in ("min", "max"):
        raise ValueError(f"unknown rule: {how}")
    return F.min if how == "min" else F.max


def advance(rows: DataFrame, path: str, batch_id: int, keys: list[str], value: Column, how: str, part: Column) -> DataFrame:
    """Merge a batch into the table and return its changes: ``keys``, part, old (null for new keys) and new.

    ``how`` is ``min`` or ``max``; ``value`` may be a struct, compared field by field. Rows with a null value, part or key
    change nothing.
    """
    spark, merge = rows.sparkSession, _merge(how)
    named = rows.select(*keys, value.alias("value"), part.alias(PART))
    # nulls go behind the written table: before it, Spark would compute every key once more for each check
    fresh = write_stage(named.groupBy(PART, *keys).agg(merge("value").alias("value")), "state-batch").dropna(subset=[*keys, "value", PART])
    touched = {str(r[0]) for r in fresh.select(F.col(PART).cast("string")).distinct().collect()}  # buckets, or days of a batch
    schema = _schema(fresh, keys)
    stored = _stored(spark, path, schema, batch_id, lambda name: name in touched)
    old = stored.select(PART, *keys, F.col("value").alias("old"))
    both = fresh.withColumnRenamed("value", "new").unionByName(old, allowMissingColumns=True)
    merged = both.groupBy(PART, *keys).agg(merge("new").alias("new"), merge("old").alias("old"))
    better = F.col("new") < F.col("old") if how == "min" else F.col("new") > F.col("old")
    changes = write_stage(merged.filter(F.col("new").isNotNull() & (F.col("old").isNull() | better)), "state-changes")
    write_parts(changes.select(*keys, F.col("new").alias("value"), PART), f"{path}/deltas", batch_id)
    return changes


def _stored(spark: SparkSession, path: str, schema: StructType, before: int, wanted=None) -> DataFrame:
    base, upto = _latest_base(spark, path)
    later = read_parts(spark, f"{path}/deltas", schema, PART, wanted).filter((F.col(BATCH) > upto) & (F.col(BATCH) < before)).drop(BATCH)
    if base is None:
        return later
    folded = StructType([f for f in schema.fields if f.name != BATCH])
    return read_parts(spark, f"{path}/base/upto={upto}", folded, PART, wanted).unionByName(later)


def read_state(spark: SparkSession, path: str, keys: list[str], how: str) -> DataFrame:
    """The table as of now: keys, part, value."""
    schema = spark.read.parquet(f"{path}/deltas").schema if exists(spark, f"{path}/deltas") else None
    if schema is None:
        raise ValueError(f"no state in {path}")
    return _stored(spark, path, schema, 1 << 62).groupBy(PART, *keys).agg(_merge(how)("value").alias("value"))


def fold_state(spark: SparkSession, path: str, keys: list[str], how: str, upto: int) -> None:
    """Fold all batches up to ``upto`` into a new base of one row per key; readers use the old one until it is complete."""
    schema = spark.read.parquet(f"{path}/deltas").schema
    rows = _stored(spark, path, schema, upto + 1)
    merged = rows.groupBy(PART, *keys).agg(_merge(how)("value").alias("value"))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(f"{path}/base/upto={upto}")
