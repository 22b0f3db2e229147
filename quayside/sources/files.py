"""CSV, Parquet and table readers and writers."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.casting import null_tokens_to_null
from quayside.schema import MASTER_COLUMNS, RAW_COLUMNS
from quayside.sources import catalog

TABLE_ORDER = ["carriers", "ports", "shipments", "weather", "master"]
STATES = ["carrier_state", "route_state", "month_state", "board", "samples"]
# Larger tables are laid out by this column, so that a filter on it skips whole folders.
PARTITION_COLUMNS = dict.fromkeys(["master", "shipments", *STATES], "departure_year")


def spanning_files(spark: SparkSession, path: str) -> dict[str, bool]:
    """The files at ``path``, and whether a quoted value in them holds a line break.

    Quotes come in pairs, also doubled ones inside a value, so a line with an odd number of them ends inside a value. All
    tasks look at lines; one row per file comes back.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2 == 1).alias("odd"))
    # File names come as they stand in addresses.
    return {unquote(r.file): r.odd for r in lines.groupBy("file").agg(F.bool_or("odd").alias("odd")).collect()}


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """A CSV with header, every column as text, "no value" texts as null. A missing path is an error.

    Quoted values may hold line breaks, for which a file has to be read by one task. By default a scan finds the files
    for which that is so, and tasks share the others; ``multiline`` says it for all files and saves the scan.
    """

    def read(paths: str | list[str], whole: bool) -> DataFrame:
        return spark.read.option("header", True).option("escape", '"').option("multiLine", whole).csv(paths)

    if multiline is not None:
        return null_tokens_to_null(read(path, multiline))
    spans = spanning_files(spark, path)
    if len(set(spans.values())) < 2:
        return null_tokens_to_null(read(path, any(spans.values())))
    parts = [read([f for f, odd in spans.items() if odd == whole], whole) for whole in (True, False)]
    return null_tokens_to_null(parts[0].unionByName(parts[1]))


def read_raw_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(RAW_COLUMNS), multiline: bool | None = None
) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{folder}/{name}.csv", multiline) for name in names}


def write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    # The writer would cut blanks off the ends of values.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _laid_out(df: DataFrame, name: str, by_year: bool = False):
    """A writer with the table's partitioning. The rebalance splits a large year and merges small ones, so
    that files come out of even size; rows that lie ``by_year`` already are not shuffled for it."""
    column = PARTITION_COLUMNS.get(name)
    if column is None:
        return df.write.mode("overwrite")
    return (df if by_year else df.hint("rebalance", column)).write.mode("overwrite").partitionBy(column)


def write_parquet_tables(tables: dict[str, DataFrame], folder: str, by_year: bool = False) -> None:
    """``by_year`` says that the rows come from files of one year each and met only broadcast tables since."""
    for name, df in _ordered(tables):
        _laid_out(df, name, by_year).parquet(f"{folder}/{name}")


def write_marts(marts: dict[str, DataFrame], folder: str) -> None:
    """A mart is small: one row per carrier, port, route or month."""
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_csv_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in _ordered(tables):
        write_csv(df, f"{folder}/{name}.csv")


def read_parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: _in_order(spark.read.parquet(f"{folder}/{name}"), name) for name in names}


def _in_order(df: DataFrame, name: str) -> DataFrame:
    """A partition column is read back as the last one; the wide table has it where it belongs."""
    if name == "master" and set(df.columns) == set(MASTER_COLUMNS):
        return df.select(*MASTER_COLUMNS)
    return df


def save_tables(tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Replace the catalog tables, each in one switch; names that are absent are skipped."""
    for name, df in _ordered(tables):
        catalog.replace_table(_laid_out(df, name), df.columns, df.sparkSession, name, database)


def write_states(states: dict[str, DataFrame], folder: str) -> None:
    """Write states by departure year. Only the years that they hold are replaced; no task has to hold a large year."""
    for name, df in states.items():
        writer = df.hint("rebalance", "departure_year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("departure_year").parquet(f"{folder}/{name}")


def _ordered(tables: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    first = [name for name in TABLE_ORDER if name in tables]
    return [(name, tables[name]) for name in [*first, *sorted(set(tables) - set(first))]]


def register_views(relations: dict[str, DataFrame]) -> None:
    for name, df in relations.items():
        df.createOrReplaceTempView(name)


def read_relations(spark: SparkSession, names: Iterable[str], cache: bool = False) -> dict[str, DataFrame]:
    """Catalog tables or views by name; ``cache`` keeps small ones, such as the marts, for many reads."""
    relations = {name: spark.table(name) for name in names}
    return {name: df.cache() for name, df in relations.items()} if cache else relations
