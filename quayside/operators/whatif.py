"""What changes in the predicted delay when shipments move to another carrier."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import display as D
from quayside.operators.features import engineer_features
from quayside.operators.models import score_delay


def whatif_carrier_switch(
    master: DataFrame,
    carriers: DataFrame,
    classifier: GBTClassificationModel,
    codes: DataFrame,
    carrier_from: str,
    carrier_to: str,
    n_sample: int = 50,
    swap: str = "id",
) -> DataFrame:
    """Mean delay probability of the first ``n_sample`` shipments of one carrier, as they are and moved.

    ``swap="id"`` changes the carrier id only, ``swap="profile"`` moves them to the other carrier with its rating and
    type. Without shipments, or for a carrier the model has not seen, the figures are null and
    ``message`` says why.
    """
    if swap not in ("profile", "id"):
        raise ValueError(f"swap must be 'profile' or 'id', not {swap!r}")
    current = master.where(F.col("carrier_id") == carrier_from).orderBy("shipment_id").limit(n_sample)
    # Each of the few shipments stands twice, as it is and moved, so that they are looked for once.
    both = current.withColumn("_moved", F.explode(F.array(F.lit(False), F.lit(True))))
    moved = {"carrier_id": F.lit(carrier_to)}
    if swap == "profile":
        profile = F.struct(F.first("rating").alias("rating"), F.first("carrier_type").alias("carrier_type"))
        found = carriers.where(F.col("carrier_id") == carrier_to).agg(profile.alias("p")).scalar()
        moved |= {"rating": found["rating"], "carrier_type": found["carrier_type"]}
    both = both.withColumns({c: F.when(F.col("_moved"), value).otherwise(F.col(c)) for c, value in moved.items()})
    scored = score_delay(engineer_features(both, codes), classifier)
    figures = scored.agg(
        F.count_if(~F.col("_moved")).alias("shipments"),
        F.avg(F.when(~F.col("_moved"), F.col("delay_probability"))).alias("now"),
        F.avg(F.when(F.col("_moved"), F.col("delay_probability"))).alias("then"),
        F.count_if(F.col("_moved") & F.col("carrier_id_enc").isNull()).alias("unseen"),
    )
    can = (F.col("shipments") > 0) & (F.col("unseen") == 0)
    result = figures.select(
        F.lit(carrier_from).alias("carrier_from"),
        F.lit(carrier_to).alias("carrier_to"),
        "shipments",
        F.when(can, F.col("now")).alias("current_probability"),
        F.when(can, F.col("then")).alias("simulated_probability"),
        F.when(can, F.col("then") - F.col("now")).alias("change"),
        "unseen",
    )
    message = (
        F.when(F.col("shipments") == 0, f"no shipments of carrier {carrier_from}")
        .when(F.col("unseen") > 0, f"carrier {carrier_to} is not in the training data")
        .when(F.col("change") < 0, "better")
        .otherwise("worse")
    )
    return result.select(
        "carrier_from",
        "carrier_to",
        "shipments",
        "current_probability",
        "simulated_probability",
        "change",
        D.percent(F.col("current_probability")).alias("current_text"),
        D.percent(F.col("simulated_probability")).alias("simulated_text"),
        F.concat(D.signed(F.col("change") * 100, 1), F.lit("%")).alias("change_text"),
        message.alias("message"),
    )
