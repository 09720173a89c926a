"""Databases and tables in the session catalog."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")


def create_table(spark: SparkSession, name: str, columns: str, fmt: str = "parquet") -> None:
    """Create an empty table from a column list such as ``"id int, name varchar(255)"``."""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING {fmt}")


def drop_databases(spark: SparkSession, names: Sequence[str], with_tables: bool = False) -> None:
    """Drop databases; one that still has tables is an error unless with_tables is set."""
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)}" + " CASCADE" * with_tables)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def list_catalog(spark: SparkSession) -> DataFrame:
    """(database, table) for every table, with a NULL table for an empty database."""
    rows = []
    for db in spark.catalog.listDatabases():
        tables = [t.name for t in spark.catalog.listTables(db.name) if not t.isTemporary]
        rows += [(db.name, t) for t in tables] or [(db.name, None)]
    return spark.createDataFrame(rows, "database string, table string")
