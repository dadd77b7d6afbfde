"""Tables: date-bounded facts, dimension snapshots, relational databases."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def facts_between(table: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows of the days ``start``..``end``. The bare column is compared, so the scan gets the filter."""
    kind = dict(table.dtypes)[ts]
    day_after = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
    return table.filter((F.col(ts) >= F.lit(start).cast("date").cast(kind)) & (F.col(ts) < day_after))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], *, query: str | None = None,
              partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 16) -> DataFrame:
    """A relational table, or a query that runs there; split into ranges when a column is named."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    reader = reader.option("dbtable", f"({query}) q" if query else table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
        )
    return reader.load()


def _day_after(day: str) -> str:
    return (date.fromisoformat(day[:10]) + timedelta(days=1)).isoformat()


def read_jdbc_between(spark: SparkSession, url: str, table: str, day_column: str, start: str, end: str,
                      properties: dict[str, str], partitions: int = 16) -> DataFrame:
    """Facts of a date range, its last day whole, one range of days per task."""
    where = f"SELECT * FROM {table} WHERE {day_column} >= '{start}' AND {day_column} < '{_day_after(end)}'"
    return read_jdbc(spark, url, table, properties, query=where, partition_column=day_column,
                     bounds=(start, end), partitions=partitions)
