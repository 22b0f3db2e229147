"""Files, tables and the batch from CSV to views."""

import pytest
from pyspark.errors import AnalysisException

from quayside.plans import etl, registry
from quayside.schema import MASTER_COLUMNS
from quayside.session import shared_dir, stage
from quayside.sources import catalog, files


def test_csv_is_text_with_nulls(spark, tmp_path):
    (tmp_path / "ports.csv").write_text('port_id,port_name,extra\nP1,"New York, ""NJ""",NA\n007,,1.50\n')
    df = files.read_csv(spark, str(tmp_path / "ports.csv"))
    assert df.dtypes == [("port_id", "string"), ("port_name", "string"), ("extra", "string")]
    assert [tuple(r) for r in df.collect()] == [("P1", 'New York, "NJ"', None), ("007", None, "1.50")]


def test_csv_round_trip(spark, tmp_path):
    rows = [("  pad ", "New\nYork\n"), ("a,b", 'say "hi"'), ("c", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    files.write_csv(df, f"{tmp_path}/t.csv")
    files.write_csv(df, f"{tmp_path}/t.csv")
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_path}/t.csv").collect())) == rows


def test_csv_without_line_breaks_in_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x,y\n"a,b",1\n c ,2\n')
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), multiline=False).collect()
    assert [tuple(r) for r in rows] == [("a,b", "1"), (" c ", "2")]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_raw_tables(spark, str(tmp_path), ["carriers"])


def test_save_tables_replaces_and_skips(spark):
    one = spark.createDataFrame([("C1",)], "carrier_id string")
    master = spark.createDataFrame([(2023, "a"), (2024, "b")], "departure_year int, v string")
    files.save_tables({"carriers": one.union(one), "master": master}, "default")
    files.save_tables({"carriers": one}, "default")
    tables = files.read_relations(spark, ["default.carriers", "default.master"])
    assert tables["default.carriers"].count() == 1
    plan = tables["default.master"].where("departure_year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(departure_year" in plan
    for name in ("carriers", "master"):
        catalog.drop_table(spark, name, "default")


def test_etl_and_views(spark, sf_dir, tmp_path):
    raw = registry.written_csvs(spark, sf_dir)
    tables = etl.run_etl(spark, raw, str(tmp_path))
    assert tables["master"].count() == tables["shipments"].count()
    assert tables["master"].columns == MASTER_COLUMNS
    assert tables["audit"].where("table_name = 'ports'").count() == 5 and tables["schema_audit"].isEmpty()
    etl.publish(tables)
    months = [r.departure_month for r in spark.table("v_monthly_kpis").collect()]
    assert months == sorted(months, key=lambda m: (m is not None, m))
    delays = [r.avg_delay for r in spark.table("v_route_performance").collect()]
    assert delays == sorted(delays)
    relations = files.read_relations(spark, etl.KPI_VIEWS, cache=True)
    assert relations["v_monthly_kpis"].agg({"total_shipments": "sum"}).first()[0] == tables["shipments"].count()
    for df in relations.values():
        df.unpersist()
    for name in [*tables, *etl.KPI_VIEWS]:
        spark.catalog.dropTempView(name)


def test_stage_uses_the_named_folder(spark):
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(shared_dir(spark) in path for path in staged.inputFiles())


def test_a_large_year_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 4).selectExpr("md5(cast(id as string)) as v", "if(id < 3, 1996, 1997) as departure_year")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        files.write_states({"board": df}, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "board" / "departure_year=1997").glob("*.parquet"))) > 1
    assert rows_of(spark, tmp_path) == rows_of(spark, tmp_path, df) != []


def rows_of(spark, folder, df=None):
    found = df if df is not None else files.read_parquet_tables(spark, str(folder), ["board"])["board"]
    return sorted(tuple(r) for r in found.select("v", "departure_year").collect())


def test_the_wide_table_is_written_where_its_rows_lie(spark, sf_dir, tmp_path, monkeypatch):
    written = {}
    laid_out = files._laid_out

    def watched(df, name, *given):
        written[name] = not any(given)
        return laid_out(df, name, *given)

    monkeypatch.setattr(files, "_laid_out", watched)
    tables = etl.run_etl(spark, registry.written_csvs(spark, sf_dir), str(tmp_path))
    assert written["shipments"] and not written["master"]
    years = {p.name for p in (tmp_path / "master").glob("departure_year=*")}
    assert years == {p.name for p in (tmp_path / "shipments").glob("departure_year=*")} and len(years) > 1
    assert tables["master"].count() == tables["shipments"].count()
