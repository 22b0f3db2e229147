"""Label codes, feature columns and train/test splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import measures as M
from quayside.functions.joins import BROADCAST_BYTES
from quayside.functions.ordering import hash_order, label_cuts, running_total

# The columns that are encoded, in order.
CATEGORIES = ["carrier_id", "origin_port_id", "destination_port_id", "origin_region", "dest_region", "carrier_type"]

# The model inputs, in order.
FEATURES = [
    "carrier_id_enc",
    "origin_port_id_enc",
    "destination_port_id_enc",
    "origin_region_enc",
    "dest_region_enc",
    "carrier_type_enc",
    "rating",
    "origin_congestion",
    "dest_congestion",
    "origin_weather_severity",
    "origin_wind_kmh",
    "departure_month_num",
    "departure_dow",
]
COST_FEATURES = [*FEATURES, "transit_days", "delay_days"]

NO_CATEGORY = "nan"
TRAIN_SHARE = 0.8
SEED = 42


def label_codes(*tables: DataFrame) -> DataFrame:
    """``kind, value, code``: per category column its values in alphabetical order, numbered from 0.

    The columns may come from one table or, as each is numbered on its own, from several that have some of them; those of a
    table are collected in one pass. The codes stay a table, whatever the number of carriers, and are read by every later
    encoding, so they should be staged.
    """
    held = [(table, [c for c in CATEGORIES if c in table.columns]) for table in tables]
    long = reduce(DataFrame.unionAll, [table.select(*columns).unpivot([], columns, "kind", "value") for table, columns in held])
    distinct = long.select("kind", F.coalesce("value", F.lit(NO_CATEGORY)).alias("value")).distinct()
    numbered = running_total(distinct, "value", F.lit(1), "position", within=["kind"])
    return numbered.select("kind", "value", (F.col("position") - 1).alias("code"))


def encode(df: DataFrame, codes: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``<column>_enc`` per category; a value that was not seen gets null."""
    size = F.sum(F.octet_length("value") + 24).alias("size")
    sizes = {r["kind"]: r["size"] for r in codes.groupBy("kind").agg(size).collect()}
    for c in CATEGORIES:
        side = codes.where(F.col("kind") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"{c}_enc"))
        if sizes.get(c, 0) <= limit:
            side = F.broadcast(side)
        df = df.withColumn("_value", F.coalesce(c, F.lit(NO_CATEGORY))).join(side, "_value", "left").drop("_value")
    return df


def engineer_features(master: DataFrame, codes: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return encode(master, codes, limit).withColumns(
        {
            "departure_month_num": M.month_number(F.col("departure_date")),
            "departure_dow": M.monday_weekday(F.col("departure_date")),
            "delay_binary": M.is_delayed(F.col("delay_days")),
        }
    )


def feature_table(master: DataFrame, codes: DataFrame) -> DataFrame:
    return engineer_features(master, codes).select("shipment_id", *FEATURES, "delay_binary")


def labelled(shipments: DataFrame) -> DataFrame:
    """Shipment ids with the label alone."""
    return shipments.select("shipment_id", M.is_delayed(F.col("delay_days")).alias("delay_binary"))


def split_cuts(df: DataFrame, label: str, key: str = "shipment_id", seed: int = SEED) -> dict[int, str]:
    """Per label the hash up to which exactly ``floor(0.8 n)`` rows lie.

    ``df`` is read several times and should be a written table; ``label`` has few values.
    """
    hashed = df.select(label, hash_order(key, seed).alias("_hash"))
    return {r[label]: r["cut"] for r in label_cuts(hashed, label, "_hash", TRAIN_SHARE).collect()}


def mark_split(df: DataFrame, label: str, cuts: dict[int, str], key: str = "shipment_id", seed: int = SEED) -> DataFrame:
    """Add ``is_train`` by cuts that were found before."""
    # No hash is below the empty text, so a label without training rows has none.
    upto = F.lit("")
    for value, cut in cuts.items():
        upto = F.when(F.col(label) == value, F.lit(cut or "")).otherwise(upto)
    return df.withColumn("is_train", hash_order(key, seed) <= upto)


def stratified_split(df: DataFrame, label: str, key: str = "shipment_id", seed: int = SEED) -> DataFrame:
    """Add ``is_train``: per label exactly ``floor(0.8 n)`` rows, the first in hash order."""
    return mark_split(df, label, split_cuts(df, label, key, seed), key, seed)


def plain_split(df: DataFrame, key: str = "shipment_id", seed: int = SEED) -> DataFrame:
    """Add ``is_train`` for about 80 % of the rows, by hash alone."""
    # The hash is uniform, so the share is a bound on its first eight hex digits.
    bound = f"{int(TRAIN_SHARE * 16**8):08x}"
    return df.withColumn("is_train", F.substring(hash_order(key, seed), 1, 8) <= bound)
