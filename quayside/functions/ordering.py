"""Order statistics that stay exact without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 256  # at least, where there are keys enough
PER_SLICE = 500_000  # keys that a slice should hold at most
MOST_SLICES = 1 << 16
DRAWS = 16  # keys drawn for each cut, so that slices differ little in size
WIDE = 256  # cuts that one step of the search looks at


def sliced(df: DataFrame, key: str) -> DataFrame:
    """Adds ``_slice``: slices of about equal size that follow each other in ``key`` order, nulls in the first.

    Their number follows the number of keys, which is counted with the draw. Keys are drawn by hash, every 16th of
    them cuts; up to 33 billion keys a slice holds about ``PER_SLICE``, beyond that slices grow.
    """
    n = F.count(key)
    wanted = F.least(F.greatest(F.ceil(n / PER_SLICE), F.lit(SLICES)), F.lit(MOST_SLICES))
    share = df.agg((wanted * DRAWS / F.greatest(n, F.lit(1))).alias("share")).scalar()
    drawn = df.select(key).where(F.col(key).isNotNull())
    drawn = drawn.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) < share * F.lit(1 << 30))
    cuts = F.filter(F.array_sort(F.collect_set(key)), lambda _, k: k % DRAWS == DRAWS - 1)
    cuts = drawn.agg(cuts.alias("cuts"))
    steps = F.sequence(F.lit(0), F.floor((F.size("cuts") - 1) / WIDE).cast("int"))
    tree = F.when(F.size("cuts") > 0, F.transform(steps, lambda k: F.slice("cuts", k * WIDE + 1, F.lit(WIDE))))
    # First the stretch of cuts, then the place in it: two short searches for up to 65,536 slices.
    searched = df.withColumn("_cuts", cuts.select(tree.alias("tree")).scalar())
    searched = searched.withColumn("_stretch", F.size(F.filter("_cuts", lambda c: c[0] <= F.col(key))))
    place = F.size(F.filter(F.get("_cuts", F.col("_stretch") - 1), lambda c: c <= F.col(key)))
    at = F.when(F.col("_stretch") > 0, (F.col("_stretch") - 1) * WIDE + place)
    # Never null, so that a join on the slice adds no null check, which would move below the caller's groupBy
    # and run for every row there.
    return searched.withColumn("_slice", F.coalesce(at, F.lit(0))).drop("_cuts", "_stretch")


def running_total(df: DataFrame, key: str, weight: Column, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``weight`` in ``key`` order (per ``within``), nulls first; ``key`` is unique per ``within``.

    An unpartitioned window would pull every row into one task. Here each slice of the key range is summed on its
    own and then shifted by the total of the slices before it.
    """
    sliced_up = sliced(df, key).withColumn("_weight", weight)

    group = [*within, "_slice"]
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced_up.groupBy(*group)
        .agg(F.sum("_weight").alias("_total"))
        .select(*group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*group).orderBy(F.col(key).asc_nulls_first())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced_up.withColumn("_inside", F.sum("_weight").over(upto))
        .join(offsets, group)
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_weight", "_inside", "_offset")
    )


def weighted_median(df: DataFrame, value: str, weight: str) -> DataFrame:
    """One row ``median``: the exact median of ``value`` with every row counted ``weight`` times.

    An even count gives the mean of the two middle values. Rows are first merged to one per distinct value.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(weight).alias("_n"))
    total = F.col("_total")
    placed = running_total(counted, value, F.col("_n"), "_upto").withColumn("_total", counted.agg(F.sum("_n")).scalar())
    # With n values the middle ones stand at positions floor((n + 1) / 2) and floor(n / 2) + 1.
    low = F.min(F.when(F.col("_upto") >= F.floor((total + 1) / 2), F.col(value)))
    high = F.min(F.when(F.col("_upto") >= F.floor(total / 2) + 1, F.col(value)))
    return placed.agg(((low + high) / 2).alias("median"))


def hash_order(key: str, seed: int) -> Column:
    """A reproducible shuffle order."""
    return F.md5(F.concat(F.col(key), F.lit(f"-{seed}")))


def label_cuts(df: DataFrame, label: str, hashed: str, fraction: float) -> DataFrame:
    """Per label the hash up to which exactly ``floor(fraction * n)`` rows lie: columns ``label``, ``cut``.

    The hash is narrowed by its leading digits: counts per 3-digit prefix find the prefix in which the cut
    falls, counts per 6-digit prefix narrow it inside that one, and only the rows of the last prefix (one in
    16 million) are ranked.
    """
    by_label = Window.partitionBy(label)

    def narrow(rows: DataFrame, digits: int, quota: Column) -> DataFrame:
        earlier = by_label.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy(label, F.substring(hashed, 1, digits).alias("_prefix")).agg(
            F.count("*").alias("_n"), F.max(quota).alias("_given")
        )
        # A quota of all rows ends with the last prefix.
        whole_last = (F.col("_quota") == F.col("_all")) & (F.col("_upto") == F.col("_all"))
        return (
            counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
            .withColumn("_all", F.sum("_n").over(by_label))
            .withColumn("_quota", F.coalesce("_given", F.floor(F.col("_all") * F.lit(fraction))))
            .withColumn("_upto", F.col("_before") + F.col("_n"))
            .where((F.col("_before") <= F.col("_quota")) & ((F.col("_quota") < F.col("_upto")) | whole_last))
            .select(label, F.col("_prefix").alias("_edge"), (F.col("_quota") - F.col("_before")).alias("_left"))
        )

    def at_edge(edges: DataFrame, digits: int) -> DataFrame:
        prefixed = df.select(label, hashed, F.substring(hashed, 1, digits).alias("_edge"))
        return prefixed.join(edges, [label, "_edge"])

    coarse = narrow(df, 3, F.lit(None).cast("bigint"))
    fine = narrow(at_edge(coarse, 3), 6, F.col("_left"))
    ranked = at_edge(fine, 6).withColumn("_rank", F.row_number().over(by_label.orderBy(hashed)))
    # Nothing left to take in the last prefix: the bare prefix sorts before all its rows.
    taken = F.max(F.when(F.col("_rank") == F.col("_left"), F.col(hashed)))
    return ranked.groupBy(label).agg(F.coalesce(taken, F.max("_edge")).alias("cut"))
