"""Results of micro-batches, each in its own partition: a replayed batch replaces itself, also by no rows.

Readers combine the batches by key. So sums stay right when a batch runs twice, and no batch rewrites the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sinks.tables import ADD, GREATEST, REPLACE, exists, folders

BATCH = "batch_id"


def write_delta(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={batch_id}")


def read_deltas(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All batches; an empty table when none wrote yet and a ``schema`` is given."""
    if schema and not any(f.startswith(BATCH) for f in folders(spark, path)):
        return spark.createDataFrame([], f"{schema}, {BATCH} long")
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, {BATCH} long")
    return reader.parquet(path)


def merged(rows: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    pick = {ADD: F.sum, GREATEST: F.max, REPLACE: lambda c: F.max_by(c, BATCH)}
    return rows.groupBy(*keys).agg(*[pick[rule](column).alias(column) for column, rule in rules.items()])


def read_merged(spark: SparkSession, path: str, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """The table as of now: the latest folded base and the batches after it."""
    base, upto = _latest_base(spark, path)
    rows = spark.read.parquet(f"{path}/deltas") if exists(spark, f"{path}/deltas") else None
    if base is not None:
        later = base.withColumn(BATCH, F.lit(upto).cast("long"))
        rows = later if rows is None else later.unionByName(rows.filter(F.col(BATCH) > upto))
    return merged(rows, keys, rules)


def add_batch(df: DataFrame, path: str, batch_id: int) -> None:
    write_delta(df, f"{path}/deltas", batch_id)


def _latest_base(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    done = [int(f.split("=")[1]) for f in folders(spark, f"{path}/base") if exists(spark, f"{path}/base/{f}/_SUCCESS")]
    if not done:
        return None, -1
    return spark.read.parquet(f"{path}/base/upto={max(done)}"), max(done)


def fold(spark: SparkSession, path: str, keys: list[str], rules: dict[str, str], upto: int) -> None:
    """Fold all batches up to ``upto`` into a new base. Until it is complete, readers use the one before."""
    base, seen = _latest_base(spark, path)
    rows = spark.read.parquet(f"{path}/deltas").filter((F.col(BATCH) <= upto) & (F.col(BATCH) > seen))
    if base is not None:
        rows = rows.unionByName(base.withColumn(BATCH, F.lit(seen).cast("long")))
    merged(rows, keys, rules).write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
