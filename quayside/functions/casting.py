"""Lenient casts: a value that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.schema import NULL_TOKENS


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Replace the usual "no value" texts by null in every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in texts})


def lenient_double(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # A JVM number may end in a type letter ("4.5d"); no data file means that.
        value = F.when(~value.rlike(r"[0-9.][dDfF]\s*$"), value).try_cast("double")
    else:
        value = value.cast("double")
    return F.when(~F.isnan(value), value)


def lenient_bigint(df: DataFrame, name: str) -> Column:
    """Whole numbers only; a fraction becomes null."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    value = lenient_double(df, name)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def lenient_date(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # The cast alone would also take a bare year or cut off a time of day.
        return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast("date"))
    return value.cast("date")


def strip(value: Column) -> Column:
    """Cut white space of any kind (``trim`` cuts blanks only)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")
