"""Writing results: snapshots, reports, and keyed tables over partitioned parquet.

Keyed tables rewrite only the partitions they touch. The merged rows are first written beside the table,
then put in place with dynamic partition overwrite, so the table is never read and written by one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import write_stage

KEEP, REPLACE, ADD, GREATEST = "keep", "replace", "add", "greatest"


def add_if(date_column: str) -> str:
    """Rule: add only when the new row's date is not older than the stored one's."""
    return f"add_if:{date_column}"


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A report with a header line in each file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 5_000) -> None:
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).option("batchsize", batch_size).options(**properties).save()


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions that ``df`` has rows for; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def replace_date_range(df: DataFrame, path: str, day: str, start: str, end: str) -> None:
    """Make the days ``start``..``end`` hold exactly the rows of ``df``: days without rows lose theirs."""
    spark = df.sparkSession
    inside = write_stage(df.filter(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))), "range")
    overwrite_partitions(inside, path, [day])
    filled = {f"{day}={r[0]}" for r in inside.select(F.col(day).cast("string")).distinct().toLocalIterator()}  # one value per day
    fs, where = _files(spark, path)
    for name in folders(spark, path):
        if f"{day}={start}" <= name <= f"{day}={end}" and name not in filled:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, name), True)


def combined(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str], version: str | None = None) -> DataFrame:
    """Old and new rows as one row per key, each column by its rule. One aggregation, combined before the shuffle.

    New rows of one key are ordered by ``version`` where that matters.
    """
    stamp = lambda df, age: df.withColumn("_v", F.struct(F.lit(age).alias("age"), (F.col(version) if version else F.lit(0)).alias("at")))
    for column, rule in rules.items():
        if rule.startswith("add_if:"):  # what is older than the stored date adds nothing
            date = rule.split(":", 1)[1]
            stored = old.groupBy(*keys).agg(F.max(date).alias("_stored"))
            late = F.col("_stored").isNotNull() & (F.col(date) < F.col("_stored"))
            new = new.join(stored, keys, "left").withColumn(column, F.when(late, 0).otherwise(F.col(column))).drop("_stored")
    # a column that the stored rows lack is null there
    both = stamp(old, 0).unionByName(stamp(new, 1), allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[_by_rule(column, rule).alias(column) for column, rule in rules.items()])


def _by_rule(column: str, rule: str) -> Column:
    value = F.col(column)
    if rule == ADD or rule.startswith("add_if:"):
        return F.sum(value)
    if rule == GREATEST:
        return F.max(value)
    if rule == REPLACE:
        return F.max_by(value, "_v")
    if rule == KEEP:
        return F.min_by(value, "_v")
    raise ValueError(f"unknown rule: {rule}")


def _touched(spark: SparkSession, path: str, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """The stored rows of the partitions that ``new`` has rows for (pruned at run time)."""
    stored = spark.read.parquet(path)
    return stored.join(new.select(*partition_by).distinct(), partition_by, "left_semi")


def upsert(new: DataFrame, path: str, keys: list[str], rules: dict[str, str], partition_by: list[str], version: str | None = None) -> None:
    """Insert rows of new keys, change stored ones column by column as ``rules`` say.

    ``partition_by`` must be among the keys, so that a row never changes its partition.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be keys")
    spark = new.sparkSession
    new = write_stage(new, "upsert-new")
    old = _touched(spark, path, new, partition_by) if exists(spark, path) else new.limit(0)
    overwrite_partitions(write_stage(combined(old, new, keys, rules, version), "upsert-merged"), path, partition_by)


def update_matching(new: DataFrame, path: str, keys: list[str], rules: dict[str, str], partition_by: list[str]) -> None:
    """Change stored rows only; rows of unknown keys are left out."""
    spark = new.sparkSession
    known = spark.read.parquet(path).select(*keys).join(new.select(*keys).distinct(), keys, "left_semi")
    upsert(new.join(known, keys, "left_semi"), path, keys, rules, partition_by)


def append_detail(new: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str] | None = None) -> None:
    """Add the first row of each key that the table does not hold yet."""
    from playlens.operators.keyed import first_row
    spark = new.sparkSession
    fresh = first_row(new, keys, order)
    if exists(spark, path):
        fresh = write_stage(fresh.join(spark.read.parquet(path).select(*keys), keys, "left_anti"), "append-new")
    append_table(fresh, path, partition_by)
