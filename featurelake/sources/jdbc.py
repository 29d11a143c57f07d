"""JDBC reads (parallel by range) and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def postgres_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. Spark refuses ``query`` together with a partition column, so the query is
    wrapped as a derived table."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    parallel = partition_column is not None
    if query is not None and not parallel:
        options["query"] = query
    else:
        options["dbtable"] = table if query is None else f"({query}) t"
    if parallel:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, **arguments) -> DataFrame:
    """Table or query; see ``jdbc_options``. Filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **arguments)).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append",
    batch_size: int = 10_000, num_partitions: int = 16,
) -> None:
    """Append rows; at most ``num_partitions`` connections write at once."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .options(url=url, dbtable=table, batchsize=str(batch_size), numPartitions=str(num_partitions), **(properties or {}))
        .save()
    )
