"""Relational sources and targets over JDBC.

The options are built here and handed to Spark's own JDBC reader and writer. A table with a numeric
key is read in key ranges by many tasks; its cursor condition is pushed to the database.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# URL scheme, driver class and default port per database.
DIALECTS = {
    "postgres": ("postgresql", "org.postgresql.Driver", 5432),
    "mssql": ("sqlserver", "com.microsoft.sqlserver.jdbc.SQLServerDriver", 1433),
    "oracle": ("oracle:thin", "oracle.jdbc.OracleDriver", 1521),
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver", 3306),
    "duckdb": ("duckdb", "org.duckdb.DuckDBDriver", 0),
    "sqlite": ("sqlite", "org.sqlite.JDBC", 0),
}
ROWS_PER_PARTITION = 2_000_000


def default_port(source_type: str) -> int:
    return DIALECTS[source_type][2] if source_type in DIALECTS else 0


def jdbc_url(source_type: str, conn: Mapping[str, object]) -> str:
    scheme, _, port = DIALECTS[source_type]
    if source_type in ("duckdb", "sqlite"):
        return f"jdbc:{scheme}:{conn['path']}"
    place = f"{conn['host']}:{conn.get('port') or port}"
    if source_type == "mssql":
        return f"jdbc:{scheme}://{place};databaseName={conn['database']}"
    if source_type == "oracle":
        return f"jdbc:{scheme}:@//{place}/{conn['database']}"
    return f"jdbc:{scheme}://{place}/{conn['database']}"


def connection_options(cfg: Mapping, connections: Mapping[str, Mapping] | None = None) -> dict[str, str]:
    """An explicit ``connection_url`` wins over ``connection_id``; one of them is needed."""
    source_type = cfg["type"]
    if source_type not in DIALECTS:
        raise ValueError(f"unknown database type {source_type!r}; allowed: {', '.join(DIALECTS)}")
    options = {"driver": DIALECTS[source_type][1]}
    if "connection_url" in cfg:
        return {**options, "url": cfg["connection_url"]}
    if "connection_id" in cfg:
        conn = (connections or {})[cfg["connection_id"]]
        options["url"] = jdbc_url(source_type, conn)
        if conn.get("login"):
            options |= {"user": conn["login"], "password": conn.get("password", "")}
        return options
    raise ValueError("a relational source needs 'connection_id' or 'connection_url'")


def table_options(connection: Mapping[str, str], schema: str | None, table: str,
                  split: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """``split`` is (numeric column, lowest value, highest value, number of partitions)."""
    options = {**connection, "dbtable": f"{schema}.{table}" if schema else table, "fetchsize": "10000"}
    if split:
        column, low, high, parts = split
        options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(parts)}
    return options


def read_table(spark: SparkSession, connection: Mapping[str, str], schema: str | None, table: str,
               split_by: str | None = None, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """With ``split_by`` the key range and row count are asked for first (one row, computed by the
    database) and set the number of parallel reads."""
    whole = spark.read.format("jdbc").options(**table_options(connection, schema, table)).load()
    if split_by is None:
        return whole
    low, high, rows = whole.agg(F.min(split_by), F.max(split_by), F.count(F.lit(1))).first()
    if not rows:
        return whole
    parts = max(1, -(-rows // rows_per_partition))
    split = (split_by, int(low), int(high) + 1, parts)
    return spark.read.format("jdbc").options(**table_options(connection, schema, table, split)).load()


def write_table(df: DataFrame, connection: Mapping[str, str], schema: str | None, table: str,
                mode: str = "append", writers: int = 16) -> None:
    """``writers`` limits the number of connections to the target."""
    options = {**table_options(connection, schema, table), "batchsize": "10000", "numPartitions": str(writers)}
    df.write.format("jdbc").options(**options).mode(mode).save()
