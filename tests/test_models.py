"""Splits, reports, saved models and the carrier switch."""

import pytest

from quayside.operators import features, models
from quayside.operators.whatif import whatif_carrier_switch
from quayside.plans import registry, training

SMALL = (3, 3, 0.3)


@pytest.fixture(scope="module")
def master(spark, sf_dir):
    return registry.wide_table(spark, sf_dir)


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    return registry.prepared(spark, sf_dir)


@pytest.fixture(scope="module")
def trained(prepared):
    return training.train_delay(prepared, SMALL)


def test_unseen_and_missing_categories(spark):
    columns = ", ".join(f"{c} string" for c in features.CATEGORIES)
    seen = spark.createDataFrame([("b", "x", "x", "x", "x", None), ("a", "x", "y", "x", "x", "z")], columns)
    codes = features.label_codes(seen)
    new = spark.createDataFrame([("c", "x", "y", "x", "x", "nan")], columns)
    rows = {r["carrier_id"]: [r[f"{c}_enc"] for c in features.CATEGORIES] for r in features.encode(seen.union(new), codes).collect()}
    assert rows == {"a": [0, 0, 1, 0, 0, 1], "b": [1, 0, 0, 0, 0, 0], "c": [None, 0, 1, 0, 0, 0]}


def test_codes_from_one_table_and_from_several(spark):
    rows = [("b", "t", "x", "r", "y", "s"), ("a", None, None, None, "x", "r"), (None, None, "x", "r", "x", "r"), ("b", "t", "z", None, "z", None)]
    columns = ["carrier_id", "carrier_type", "origin_port_id", "origin_region", "destination_port_id", "dest_region"]
    whole = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    apart = [whole.select(*columns[:2]).distinct(), whole.select(*columns[2:]).distinct()]
    one, several = ({tuple(r) for r in features.label_codes(*tables).collect()} for tables in ([whole], apart))
    assert one == several and ("carrier_type", "nan", 0) in one and ("carrier_id", "nan", 2) in one


def test_categories_come_from_carriers_and_pairs_of_ports_alone(spark, sf_dir, prepared):
    fact = registry.written_shipments(spark, sf_dir)
    most = fact.select("carrier_id").distinct().count() + fact.select("origin_port_id", "destination_port_id").distinct().count()
    assert sum(table.count() for table in prepared.categories) == most
    assert {tuple(r) for r in prepared.codes.collect()} == {tuple(r) for r in features.label_codes(prepared.master).collect()}


def test_encoding_is_the_same_without_broadcast(prepared, master):
    one = features.encode(master, prepared.codes).select("shipment_id", *[f"{c}_enc" for c in features.CATEGORIES])
    two = features.encode(master, prepared.codes, limit=-1).select(*one.columns)
    assert one.exceptAll(two).isEmpty() and one.count() == two.count()


def test_split_is_reproducible_and_complete(prepared):
    train, test = training.split(prepared)
    assert train.count() + test.count() == prepared.inputs.count()
    again, _ = training.split(training.prepare(prepared.master))
    assert train.select("shipment_id").exceptAll(again.select("shipment_id")).isEmpty()


def test_classification_report(spark):
    pairs = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4
    scored = spark.createDataFrame([(a, float(p)) for a, p in pairs], "delay_binary int, prediction double")
    report = {r["class"]: r for r in models.classification_report(scored).collect()}
    late, on_time = report["Delayed"], report["On-Time"]
    assert (late["precision"], late["recall"], late["support"]) == (0.75, 0.6, 5)
    assert late["f1"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    assert (on_time["precision"], on_time["recall"], on_time["support"]) == (pytest.approx(4 / 6), 0.8, 5)
    assert late["accuracy"] == 0.7


def test_classification_report_without_a_class(spark):
    scored = spark.createDataFrame([(0, 0.0)], "delay_binary int, prediction double")
    late = models.classification_report(scored).where("class = 'Delayed'").first()
    assert (late["precision"], late["recall"], late["f1"], late["support"]) == (0, 0, 0, 0)


def test_regression_report(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 5.0), (None, 1.0)], "y double, prediction double")
    row = models.regression_report(scored, "y").first()
    assert (row["support"], row["mae"]) == (3, pytest.approx(2 / 3))
    assert row["rmse"] == pytest.approx((2 / 3) ** 0.5) and row["r2"] == pytest.approx(1 - 2 / 14)


def test_saved_models_score_alike(spark, prepared, trained, tmp_path):
    trained.save(str(tmp_path))
    loaded = models.DelayModels.load(spark, str(tmp_path))
    first, second = (
        models.score_delay(prepared.inputs, m.classifier).select("shipment_id", "delay_probability") for m in (trained, loaded)
    )
    assert first.exceptAll(second).isEmpty()
    assert loaded.codes.count() == prepared.codes.count()


def test_run_training(spark, master, tmp_path):
    reports = training.run_training(master, str(tmp_path), SMALL, SMALL)
    assert {n: r.count() for n, r in reports.items()} == {
        "delay_classifier": 2, "delay_regressor": 1, "cost_model": 1, "feature_importance": 8,
    }
    assert (tmp_path / "label_codes").exists()
    loaded = models.load_cost_model(str(tmp_path))
    inputs = training.prepare(master).inputs
    assert models.predict_cost(inputs.limit(5), loaded).select("prediction").dropna().count() == 5


def test_missing_input_is_not_a_negative_one(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (-2.0,)], "transit_days double")
    vectors = [tuple(r.features) for r in models.assemble(df, ["transit_days"]).collect()]
    assert len(set(vectors)) == 3 and min(vectors) == (models.MISSING,)


@pytest.mark.parametrize("swap", ["id", "profile"])
def test_switch_to_the_same_carrier_changes_nothing(spark, sf_dir, master, trained, swap):
    carriers = registry.carriers(spark, sf_dir)
    row = whatif_carrier_switch(master, carriers, trained.classifier, trained.codes, "C000003", "C000003", swap=swap).first()
    assert row["shipments"] == 50
    assert row["change"] == pytest.approx(0, abs=1e-15)


def test_switch_that_cannot_be_simulated(spark, sf_dir, master, trained):
    carriers = registry.carriers(spark, sf_dir)

    def run(a, b):
        return whatif_carrier_switch(master, carriers, trained.classifier, trained.codes, a, b).first()

    none, unseen = run("C999999", "C000003"), run("C000003", "C999999")
    assert none["shipments"] == 0 and none["change"] is None and "no shipments" in none["message"]
    assert unseen["change"] is None and "not in the training data" in unseen["message"]
    with pytest.raises(ValueError):
        whatif_carrier_switch(master, carriers, trained.classifier, trained.codes, "a", "b", swap="name")
