"""Data-quality reports as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.schema import RAW_COLUMNS


def schema_audit(df: DataFrame, table: str) -> DataFrame:
    """One row per column that is missing from, or extra in, the delivered table. Names alone answer: no row is read."""
    expected, actual = set(RAW_COLUMNS[table]), set(df.columns)
    issues = [(table, c, "missing") for c in sorted(expected - actual)]
    issues += [(table, c, "extra") for c in sorted(actual - expected)]
    return df.sparkSession.createDataFrame(issues, "table_name string, column_name string, issue string")


def table_audit(df: DataFrame, table: str) -> DataFrame:
    """Per column of a table its null count, beside the table's rows and columns: all in one pass."""
    counted = df.agg(F.count("*").alias("n_rows"), F.array(*[F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]).alias("nulls"))
    names = F.array(*[F.lit(c) for c in df.columns])
    each = F.inline(F.arrays_zip(names.alias("column_name"), F.col("nulls").alias("null_count")))
    return counted.select("n_rows", each).select(
        F.lit(table).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        "column_name",
        "null_count",
    )


def null_audit(df: DataFrame, table: str) -> DataFrame:
    """Null count of every column that has nulls."""
    return table_audit(df, table).where("null_count > 0").select("table_name", "column_name", "null_count")


def row_audit(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(table).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def audit_tables(audit, tables: dict[str, DataFrame]) -> DataFrame:
    """Any of the audits over several tables, as one report."""
    return reduce(DataFrame.unionByName, [audit(df, name) for name, df in tables.items()])


def shipment_quality_metrics(shipments: DataFrame) -> DataFrame:
    """Row count, on-time share and mean delay of the late ones, over cleaned shipments."""
    return shipments.agg(
        F.count("*").alias("n_rows"),
        M.share(F.col("is_on_time")).alias("on_time_rate"),
        M.mean_late(F.col("delay_days")).alias("avg_delay_delayed"),
    )


def row_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named relation: the check after a load."""
    counts = {name: df.agg(F.count("*").alias("n_rows")) for name, df in relations.items()}
    return reduce(DataFrame.unionByName, [n.select(F.lit(name).alias("relation"), "n_rows") for name, n in counts.items()])


def preview(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first ``n`` rows in key order; a distributed table has no file order."""
    return df.orderBy(key).limit(n)
