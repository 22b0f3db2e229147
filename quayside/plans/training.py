"""The wide table to trained models and their reports."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import cached_property

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators import features as X
from quayside.operators import models
from quayside.session import exists, shared_dir, stage

# Rows of a training task: enough to be worth its start, and no more tasks than there are cores until tasks get large.
FEW_ROWS, MANY_ROWS = 25_000, 1_000_000


class Prepared:
    """What models are trained from. Each part is computed when first asked for; the inputs are written once.

    ``fact`` are the shipments alone, which labels and splits come from, and ``categories`` tables with the values
    of all category columns; without them all is taken from the wide table. Tables that are given should be written ones.
    """

    def __init__(self, master: DataFrame, fact: DataFrame | None = None, categories: Sequence[DataFrame] = ()):
        self.master, self.fact, self.categories = master, fact or master, categories or [master]

    @cached_property
    def codes(self) -> DataFrame:
        return stage(X.label_codes(*self.categories), "label-codes")

    @cached_property
    def cuts(self) -> dict[int, str]:
        """Per label the hash up to which shipments are training rows."""
        return X.split_cuts(X.labelled(self.fact), "delay_binary")

    def marked(self, df: DataFrame) -> DataFrame:
        """Add the marks of both splits to rows with a shipment id and the label."""
        both = X.mark_split(df, "delay_binary", self.cuts).withColumnRenamed("is_train", "in_delay_train")
        return X.plain_split(both).withColumnRenamed("is_train", "in_cost_train")

    @cached_property
    def inputs(self) -> DataFrame:
        kept = ["shipment_id", *X.COST_FEATURES, "delay_binary", "cost_usd"]
        return stage(self.marked(X.engineer_features(self.master, self.codes).select(*kept)), "model-inputs")


def prepare(master: DataFrame) -> Prepared:
    return Prepared(master)


def split(prepared: Prepared, stratified: bool = True) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    mark = F.col("in_delay_train" if stratified else "in_cost_train")
    return prepared.inputs.where(mark), prepared.inputs.where(~mark)


def tasks_for(rows: int, cores: int) -> int:
    return max(1, min(rows // FEW_ROWS + 1, max(cores, rows // MANY_ROWS)))


def _fitted(rows: DataFrame, columns: list[str], kind: str, shape, fit, model_class):
    """The model for these rows and this shape: the one kept in the shared folder, else a new one, which is then kept.

    A model is found by a hash of its rows, whatever their order, and of its shape.
    """
    spark = rows.sparkSession
    line = F.xxhash64(*[F.col(c) for c in columns])
    count, xor, total = rows.agg(F.count("*"), F.bit_xor(line), F.sum(line.cast("decimal(20,0)"))).first()
    name = hashlib.sha256(repr((kind, columns, shape, models.MAX_BINS, models.SAMPLED, X.SEED, count, xor, total)).encode())
    path = f"{shared_dir(spark)}/quayside/models/{kind}-{name.hexdigest()[:32]}"
    if not exists(spark, f"{path}/complete/_SUCCESS"):
        tasks = tasks_for(count, spark.sparkContext.defaultParallelism)
        fit(rows.repartition(tasks, "shipment_id"), shape).write().overwrite().save(f"{path}/model")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/complete")
    return model_class.load(f"{path}/model")


def delay_classifier(prepared: Prepared, shape=models.DELAY_SHAPE) -> GBTClassificationModel:
    train, _ = split(prepared)
    columns = [*X.FEATURES, "delay_binary"]
    return _fitted(train, columns, "delay-classifier", shape, models.train_delay_classifier, GBTClassificationModel)


def delay_regressor(prepared: Prepared, shape=models.DELAY_SHAPE) -> GBTRegressionModel:
    late = split(prepared)[0].where("delay_days > 0")
    columns = [*X.FEATURES, "delay_days"]
    return _fitted(late, columns, "delay-regressor", shape, models.train_delay_regressor, GBTRegressionModel)


def cost_model(prepared: Prepared, shape=models.COST_SHAPE) -> GBTRegressionModel:
    priced = split(prepared, stratified=False)[0].where("cost_usd is not null")
    columns = [*X.COST_FEATURES, "cost_usd"]
    return _fitted(priced, columns, "cost-model", shape, models.train_cost_model, GBTRegressionModel)


def train_delay(prepared: Prepared, shape=models.DELAY_SHAPE) -> models.DelayModels:
    return models.DelayModels(prepared.codes, delay_classifier(prepared, shape), delay_regressor(prepared, shape))


def train_cost(prepared: Prepared, shape=models.COST_SHAPE) -> GBTRegressionModel:
    return cost_model(prepared, shape)


def run_training(
    master: DataFrame, out_dir: str, delay_shape=models.DELAY_SHAPE, cost_shape=models.COST_SHAPE
) -> dict[str, DataFrame]:
    """Train and save all models under ``out_dir``; returns the hold-out reports."""
    prepared = prepare(master)
    delay = train_delay(prepared, delay_shape)
    cost = train_cost(prepared, cost_shape)
    delay.save(out_dir)
    cost.write().overwrite().save(f"{out_dir}/cost_model")

    _, test = split(prepared)
    _, cost_test = split(prepared, stratified=False)
    late = test.where("delay_days > 0")
    return {
        "delay_classifier": models.classification_report(models.score_delay(test, delay.classifier)),
        "delay_regressor": models.regression_report(models.predict_days(late, delay.regressor), "delay_days"),
        "cost_model": models.regression_report(models.predict_cost(cost_test, cost), "cost_usd"),
        "feature_importance": models.feature_importance(master.sparkSession, delay.classifier),
    }
