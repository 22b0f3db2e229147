"""The queries that return what trained models say, against brute force over the scored rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from quayside.operators import features, models
from quayside.plans import oracle, registry, training

QUERIES = registry.model_queries()


@pytest.fixture(scope="module", autouse=True)
def few_trees():
    forget()
    registry.DELAY_SHAPE, registry.COST_SHAPE = (4, 3, 0.3), (4, 3, 0.3)
    yield
    registry.DELAY_SHAPE, registry.COST_SHAPE = models.DELAY_SHAPE, models.COST_SHAPE
    forget()


def forget():
    for kept in registry.MODELS:
        kept.cache_clear()


def test_registered_models_are_the_full_ones():
    assert (models.DELAY_SHAPE, models.COST_SHAPE) == ((200, 5, 0.05), (300, 6, 0.04))


def rows(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def test_registered_without_sql():
    registered = entry_point.queries()
    assert all(registered[name] is query for name, query in QUERIES.items())
    assert not set(QUERIES) & set(oracle.oracle_sql())


def test_scores_and_classifier_report(spark, sf_dir):
    scores = {r.shipment_id: r for r in rows(spark, sf_dir, "score_shipments")}
    everything = registry.wide_table(spark, sf_dir).count()
    assert len(scores) == everything and len({r.delay_probability for r in scores.values()}) > 10
    assert all(r.prediction == (r.delay_probability > 0.5) and 0 < r.delay_probability < 1 for r in scores.values())
    _, test = training.split(registry.prepared(spark, sf_dir))
    pairs = [(r.delay_binary, int(scores[r.shipment_id].prediction)) for r in test.collect()]
    for r in rows(spark, sf_dir, "delay_classifier_metrics"):
        kind = int(r["class"] == "Delayed")
        hit = sum(a == p == kind for a, p in pairs)
        said, actual = sum(p == kind for _, p in pairs), sum(a == kind for a, _ in pairs)
        assert (r.support, r.accuracy) == (actual, pytest.approx(sum(a == p for a, p in pairs) / len(pairs)))
        assert (r.precision, r.recall) == (pytest.approx(hit / said if said else 0), pytest.approx(hit / actual))
        assert r.f1 == pytest.approx(2 * hit / (said + actual))


@pytest.mark.parametrize("name, label", [("delay_regressor_metrics", "delay_days"), ("cost_model_metrics", "cost_usd")])
def test_regressor_reports(spark, sf_dir, name, label):
    prepared = registry.prepared(spark, sf_dir)
    if label == "cost_usd":
        _, test = training.split(prepared, stratified=False)
        scored = models.predict_cost(test, registry.cost_model(spark, sf_dir))
    else:
        _, test = training.split(prepared)
        scored = models.predict_days(test.where("delay_days > 0"), registry.delay_regressor(spark, sf_dir))
    pairs = [(float(r[label]), r.prediction) for r in scored.collect() if r[label] is not None]
    mean = sum(y for y, _ in pairs) / len(pairs)
    squares = sum((y - p) ** 2 for y, p in pairs)
    (r,) = rows(spark, sf_dir, name)
    assert (r.support, r.mae) == (len(pairs), pytest.approx(sum(abs(y - p) for y, p in pairs) / len(pairs)))
    assert r.rmse == pytest.approx((squares / len(pairs)) ** 0.5)
    assert r.r2 == pytest.approx(1 - squares / sum((y - mean) ** 2 for y, _ in pairs))


def test_ranked_features(spark, sf_dir):
    shares = registry.delay_classifier(spark, sf_dir).featureImportances.toArray()
    best = sorted(zip(features.FEATURES, shares), key=lambda x: (-x[1], x[0]))[:8]
    assert [tuple(r) for r in rows(spark, sf_dir, "feature_importance")] == best


def test_switch_to_another_carrier(spark, sf_dir):
    (r,) = rows(spark, sf_dir, "whatif_carrier_switch")
    assert (r.carrier_from, r.carrier_to, r.shipments) == ("C000003", "C000007", 50)
    scores = {s.shipment_id: s.delay_probability for s in rows(spark, sf_dir, "score_shipments")}
    own = registry.wide_table(spark, sf_dir).where("carrier_id = 'C000003'").select("shipment_id").collect()
    first = sorted(s.shipment_id for s in own)[:50]
    assert r.current_probability == pytest.approx(sum(scores[k] for k in first) / 50)
    assert r.change == pytest.approx(r.simulated_probability - r.current_probability) and r.message in ("better", "worse")


SCORED_BY_NODES = f"""
with recursive inputs as (select shipment_id, list_transform([{", ".join(features.FEATURES)}], lambda x: coalesce(x::double, {models.MISSING}))
    as x from rows),
walk(shipment_id, tree, node, leaf, value) as (
  select shipment_id, tree, 0, left_node is null, weight * prediction from inputs, nodes where node = 0
  union all
  select w.shipment_id, n.tree, n.node, n.left_node is null, n.weight * n.prediction
  from walk w join inputs i using (shipment_id) join nodes p on p.tree = w.tree and p.node = w.node
    join nodes n on n.tree = w.tree and n.node = case when i.x[p.feature + 1] <= p.threshold then p.left_node else p.right_node end
  where not w.leaf)
select shipment_id, sum(value) as total from walk where leaf group by shipment_id"""


def scored_elsewhere(rows, nodes):
    """Predictions from the table of nodes, level by level, in another engine."""
    con = duckdb.connect()
    con.register("rows", rows.toPandas())
    con.register("nodes", nodes.withColumnsRenamed({"left": "left_node", "right": "right_node"}).toPandas().astype({"left_node": "Int64", "right_node": "Int64", "feature": "Int64"}))
    return dict(con.execute(SCORED_BY_NODES).fetchall())


def test_scores_from_the_table_of_nodes(spark, sf_dir):
    inputs = registry.prepared(spark, sf_dir).inputs
    totals = scored_elsewhere(inputs.select("shipment_id", *features.FEATURES), QUERIES["delay_model_nodes"](spark, sf_dir))
    scores = rows(spark, sf_dir, "score_shipments")
    assert len(totals) == len(scores)
    for r in scores:
        assert r.delay_probability == pytest.approx(1 / (1 + math.exp(-2 * totals[r.shipment_id])), abs=1e-9)


def test_days_from_the_table_of_nodes(spark, sf_dir, tmp_path):
    registry.delay_regressor(spark, sf_dir).write().save(f"{tmp_path}/regressor")
    inputs = registry.prepared(spark, sf_dir).inputs.limit(500)
    scored = models.predict_days(inputs, registry.delay_regressor(spark, sf_dir)).collect()
    totals = scored_elsewhere(inputs.select("shipment_id", *features.FEATURES), models.node_table(spark, f"{tmp_path}/regressor"))
    assert {r.shipment_id: pytest.approx(r.prediction) for r in scored} == totals


def test_a_model_is_trained_once_for_the_same_rows(spark, sf_dir, monkeypatch):
    prepared = registry.prepared(spark, sf_dir)
    first = training.cost_model(prepared, (3, 2, 0.5))
    monkeypatch.setattr(models, "train_cost_model", lambda *_: pytest.fail("trained again"))
    again = training.cost_model(prepared, (3, 2, 0.5))
    assert first.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    with pytest.raises(pytest.fail.Exception):
        training.cost_model(prepared, (3, 2, 0.4))


def test_only_what_is_asked_is_trained(spark, sf_dir, monkeypatch):
    for kind in ("train_delay_regressor", "train_cost_model"):
        monkeypatch.setattr(models, kind, lambda *_: pytest.fail("not asked for"))
    forget()
    for name in ("delay_classifier_metrics", "feature_importance", "score_shipments", "whatif_carrier_switch"):
        assert rows(spark, sf_dir, name)


def test_tasks_follow_the_rows():
    assert [training.tasks_for(n, 8) for n in (0, 10_000, 60_000, 10**6, 10**7, 10**9)] == [1, 1, 3, 8, 10, 1000]
