"""What the operators here agree on: words are runs of anything but the six ASCII blanks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def labelled(labels: DataFrame, key: str, label: str, held_out: Column) -> DataFrame:
    """The labels 0 and 1 of keys that are not held out, as ``key, y``.

    A key that is repeated, however often, is one row with the label that most of its rows give, 1 if as many give 0.
    """
    known = labels.select(F.col(f"`{key}`"), F.col(f"`{label}`").cast("int").alias("y")).where(F.col("y").isin(0, 1))
    known = known.where(~F.coalesce(held_out, F.lit(False))).select(F.col(f"`{key}`").alias("key"), "y")
    return known.groupBy("key").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
