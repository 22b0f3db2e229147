"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small, measured_bytes
from quayside.operators import enrich, quality
from quayside.sources import testdata
from quayside.plans import registry
from quayside.session import stage

# These train models or run whole batches before there is a plan to look at.
EAGER = ("delay_c", "delay_r", "cost_model", "feature_importance", "score_", "whatif", "etl_", "saved_", "year_")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_master_broadcasts_measured_sides(spark, sf_dir):
    text = plan(registry.master(spark, sf_dir))
    for key in ("carrier_id", "origin_port_id", "destination_port_id"):
        assert re.search(rf"BroadcastHashJoin \[{key}#\d+\], \[\w+#\d+\], LeftOuter", text), key
    assert re.search(r"BroadcastHashJoin \[origin_port_id#\d+, departure_date#\d+\], \[\w+#\d+, \w+#\d+\], LeftOuter", text)
    assert "SortMergeJoin" not in text


def test_master_reads_the_fact_once(spark, sf_dir):
    master = registry.master(spark, sf_dir)
    assert not any("lineitem" in path for path in master.inputFiles())  # the cleaned shipments are staged
    assert len(re.findall(r"FileScan parquet \[[^\]]*origin_port_id", plan(master))) == 1


def test_audit_reads_each_table_once(spark, sf_dir):
    tables = registry.raw(spark, sf_dir)
    text = plan(quality.table_audit(tables["shipments"], "shipments"))
    assert text.count("lineitem.parquet") == 1
    assert "Scan parquet" not in plan(registry.schema_audit(spark, sf_dir))


def test_switch_looks_for_its_shipments_once(spark, sf_dir):
    master = stage(registry.wide_table(spark, sf_dir), "master")
    current = master.where("carrier_id = 'C000003'").orderBy("shipment_id").limit(50)
    both = current.withColumn("_moved", F.explode(F.array(F.lit(False), F.lit(True))))
    assert plan(both).count("TakeOrderedAndProject") == 1
    # Over the joins, too, the shipments of the carrier are looked for in one scan.
    lazy = registry.wide_table(spark, sf_dir).where("carrier_id = 'C000003'").orderBy("shipment_id").limit(50)
    assert plan(lazy.withColumn("_moved", F.explode(F.array(F.lit(False), F.lit(True))))).count("EqualTo(carrier_id,C000003)") == 1


def test_master_without_broadcast_is_the_same(spark, sf_dir):
    small = registry.master(spark, sf_dir)
    tables = [make(spark, sf_dir) for make in (registry.shipments, registry.carriers, registry.ports, registry.weather)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich.build_master(*tables, limit=-1)
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert small.exceptAll(large).isEmpty() and small.count() == large.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n bigint")
    assert measured_bytes(df) == 2 * 16 + 3
    assert measured_bytes(df.where("n > 5")) == 0
    assert "ResolvedHint" in broadcast_if_small(df, 35)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(df, 34)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if not n.startswith(EAGER)))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert not re.search(r"PythonUDF|ArrowEval|BatchEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|NestedLoop", text)


def test_dashboard_filter_prunes_partitions_and_columns(spark, sf_dir, tmp_path):
    from quayside.operators.dashboards import kpi_strip
    from quayside.sources.files import read_parquet_tables, write_parquet_tables

    write_parquet_tables({"master": registry.master(spark, sf_dir)}, str(tmp_path))
    master = read_parquet_tables(spark, str(tmp_path), ["master"])["master"]
    text = plan(kpi_strip(master, [1996], ["ASIA"]))
    assert "PartitionFilters: [isnotnull(departure_year" in text or "PartitionFilters: [(departure_year" in text
    assert "EqualTo(origin_region,ASIA)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "shipment_id" not in schema and "route" not in schema


def test_unused_weather_join_reads_no_weather(spark, sf_dir):
    ships = stage(registry.shipments(spark, sf_dir), "shipments")
    daily = enrich.weather_daily_max(registry.weather(spark, sf_dir))
    wide = enrich.attach_weather(ships, daily).select("shipment_id", "cost_usd")
    assert "Join" not in plan(wide)


def test_hot_carrier_is_split_in_the_shuffle_join(spark):
    """A third of the shipments on one carrier, too many carriers to broadcast."""
    ships = spark.range(120_000).selectExpr(
        "id as shipment_id", "if(id % 3 = 0, 'hot', 'C' || id) as carrier_id", "md5(cast(id as string)) as note"
    )
    carriers = spark.range(120_000).selectExpr(
        "if(id = 0, 'hot', 'C' || id) as carrier_id", "'n' || id as carrier_name", "'Air' as carrier_type",
        "4.0D as rating", "'X' as country",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        wide = enrich.attach_carrier(ships.repartition(8), broadcast_if_small(carriers, limit=0))
        counted = wide.groupBy("carrier_name").agg(F.count("*").alias("count"), F.max("note"))
        rows = {r["carrier_name"]: r["count"] for r in counted.collect()}
        assert rows["n0"] == 40_000 and len(rows) == 80_001
        assert "skew=true" in plan(counted)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_line_items_meet_orders_in_as_many_tasks_as_they_need(spark, sf_dir, monkeypatch):
    few = testdata.shipments(spark, sf_dir)
    rows = testdata._table(spark, sf_dir, "lineitem").count()
    monkeypatch.setattr(testdata, "LINES_PER_TASK", rows // 9)
    testdata._join_tasks.cache_clear()
    try:
        many = testdata.shipments(spark, sf_dir)
    finally:
        testdata._join_tasks.cache_clear()
    assert many.rdd.getNumPartitions() >= 9 and many.exceptAll(few).isEmpty() and many.count() == few.count()
