"""Tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 16,
    fetch_size: int = 100_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read in ranges side by side."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """The table as a lazy DataFrame. The JDBC driver has to be on the classpath."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()
