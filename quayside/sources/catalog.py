"""Catalog tables that are replaced without a gap, and views over them that outlive the session.

A table is a view of its name over the newest of its versions. A load writes a new version beside the present one and then
switches the name, which is one change of the catalog: a reader finds the old rows or the new ones. The version before stays
for readers that have begun; older ones are dropped.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

KEPT_VERSIONS = 2


def qualified(name: str, database: str | None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def _relations(spark: SparkSession, database: str | None) -> dict[str, str]:
    """Names of the database with what they are."""
    found = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return {t.name: t.tableType for t in found if not t.isTemporary}


def versions(spark: SparkSession, name: str, database: str | None = None) -> list[str]:
    """The versions of a table, oldest first; their names sort by time."""
    return sorted(t for t in _relations(spark, database) if t.startswith(f"{name}__v"))


def replace_table(writer, columns: list[str], spark: SparkSession, name: str, database: str | None = None) -> None:
    """Save what ``writer`` holds as the newest version of ``name`` and switch the name to it."""
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer.format("parquet").saveAsTable(qualified(version, database))
    listed = ", ".join(f"`{c}`" for c in columns)
    if _relations(spark, database).get(name, "VIEW") != "VIEW":
        spark.sql(f"drop table {qualified(name, database)}")  # saved before names were views
    spark.sql(f"create or replace view {qualified(name, database)} as select {listed} from {qualified(version, database)}")
    for old in versions(spark, name, database)[:-KEPT_VERSIONS]:
        spark.sql(f"drop table if exists {qualified(old, database)}")


def drop_table(spark: SparkSession, name: str, database: str | None = None) -> None:
    spark.sql(f"drop view if exists {qualified(name, database)}")
    for version in versions(spark, name, database):
        spark.sql(f"drop table if exists {qualified(version, database)}")


def create_views(spark: SparkSession, views: dict[str, str], database: str | None = None) -> None:
    """Create or replace catalog views; ``{name}`` in their SQL stands for a relation of the database."""

    class Names(dict):
        def __missing__(self, name: str) -> str:
            return qualified(name, database)

    for name, sql in views.items():
        if _relations(spark, database).get(name, "VIEW") != "VIEW":
            spark.sql(f"drop table {qualified(name, database)}")
        spark.sql(f"create or replace view {qualified(name, database)} as {sql.format_map(Names())}")


def table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(qualified(name, database))
