"""States, boards, replaced tables and views against what is computed from shipments."""

import math

import pytest
from pyspark.sql import functions as F

from quayside.operators import clean, dashboards, marts, states
from quayside.plans import dashboard, etl, registry
from quayside.schema import MASTER_COLUMNS
from quayside.sources import catalog, files

CHOICES = [(None, None), ([1996, 1997], ["ASIA", "EUROPE"]), ([], ["ASIA"])]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {n: getattr(registry, n)(spark, sf_dir) for n in ("carriers", "ports")} | {
        "shipments": registry.written_shipments(spark, sf_dir)
    }


@pytest.fixture(scope="module")
def odd_tables(spark):
    """Null keys, unknown ports, costs that are no money, rows without any measure."""
    ships = spark.createDataFrame(
        [
            ("a", "P1", "P2", "C1", "2023-01-05", "2023-01-10", "2023-01-12", 10.25, "Delivered"),
            ("b", "P1", "P2", "C1", "2023-01-05", "2023-01-10", None, float("inf"), "In Transit"),
            ("c", "P9", "P2", "C2", "2024-01-05", "2024-01-10", "2024-01-10", float("nan"), "Delivered"),
            (None, None, None, None, None, None, None, None, None),
            ("d", "P2", "P1", "C9", "2024-02-05", "2024-02-10", "2024-02-09", None, "Delivered"),
            ("a", "P1", "P2", "C1", "2023-01-05", "2023-01-10", "2023-01-12", 10.25, "Delivered"),
        ],
        "shipment_id string, origin_port_id string, destination_port_id string, carrier_id string, departure_date string, "
        "scheduled_arrival string, actual_arrival string, cost_usd double, status string",
    )
    carriers = spark.createDataFrame(
        [("C1", "One", "Air", "X", "4.5", "7"), ("C2", None, "Sea", None, None, "x")],
        "carrier_id string, carrier_name string, carrier_type string, country string, rating string, fleet_size string",
    )
    ports = spark.createDataFrame(
        [("P1", "Aa", "X", "ASIA", "0.5"), ("P2", "Bb", "Y", None, "0.9"), ("P3", "Cc", "Z", "EUROPE", None)],
        "port_id string, port_name string, country string, region string, congestion_index string",
    )
    raw = {"shipments": ships, "carriers": carriers, "ports": ports}
    return {name: clean.CLEANERS[name](df) for name, df in raw.items()}


def rows(df):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)


def expected_marts(tables):
    shipments = tables["shipments"]
    return {
        "v_carrier_kpis": marts.carrier_kpis(shipments, tables["carriers"]),
        "v_port_congestion": marts.port_congestion(shipments, tables["ports"]),
        "v_route_performance": marts.route_performance(shipments, tables["ports"]),
        "v_monthly_kpis": marts.monthly_kpis(shipments),
    }


@pytest.mark.parametrize("kind", ["tables", "odd_tables"])
def test_views_equal_marts(spark, request, kind):
    given = request.getfixturevalue(kind)
    spark.sql(f"create database {kind}_views")
    try:
        etl.save(given, f"{kind}_views")
        for name, mart in expected_marts(given).items():
            view = catalog.table(spark.newSession(), name, f"{kind}_views")
            assert view.columns == mart.columns and [f.dataType for f in view.schema] == [f.dataType for f in mart.schema]
            assert rows(view) == rows(mart), name
    finally:
        spark.sql(f"drop database {kind}_views cascade")


@pytest.mark.parametrize("kind", ["tables", "odd_tables"])
@pytest.mark.parametrize("years, regions", CHOICES)
def test_boards_equal_shipments(spark, request, kind, years, regions):
    given = request.getfixturevalue(kind)
    board = states.board(given["shipments"], given["carriers"], given["ports"])
    ports = given["ports"].select(F.col("port_id").alias("origin_port_id"), F.col("region").alias("origin_region"))
    wide = given["shipments"].join(ports, "origin_port_id", "left").join(given["carriers"].drop("country"), "carrier_id", "left")
    names = ("Supplier#000000003", "Supplier#000000007") if kind == "tables" else ("One", "Two")
    assert rows(dashboards.kpi_strip_of_board(board, years, regions)) == rows(dashboards.kpi_strip(wide, years, regions))
    assert rows(dashboards.delay_histogram_of_board(board, years, regions)) == rows(dashboards.delay_histogram(wide, years, regions))
    assert rows(dashboards.carrier_compare_of_board(board, years, regions, *names)) == rows(
        dashboards.carrier_compare(wide, years, regions, *names)
    )
    assert rows(dashboards.filter_options(board)) == rows(dashboards.filter_options(wide))
    samples = dashboards.samples(given["shipments"], given["carriers"], given["ports"])
    for n in (1, 300):
        assert rows(dashboards.cost_delay_sample_of(samples, years, regions, n)) == rows(
            dashboards.cost_delay_sample(wide, years, regions, n)
        )


@pytest.mark.parametrize("kind", ["tables", "odd_tables"])
@pytest.mark.parametrize("n", [1, 7, 300])
def test_samples_of_written_shipments(request, kind, n):
    given = request.getfixturevalue(kind)
    sides = given["shipments"], given["carriers"], given["ports"]
    assert rows(dashboards.samples(*sides, n, written=True)) == rows(dashboards.samples(*sides, n))


def test_few_shipments_are_sorted_for_samples(spark):
    places = [("a", f"{i:02x}{k}") for i in range(256) for k in range(4)] + [("b", "00x")] + [("c", None)] * 9 + [(None, "7fx")] * 9
    edges = dashboards.first_prefixes(spark.createDataFrame(places, "port string, place string"), ["port"], 9)
    assert {tuple(r) for r in edges.collect()} == {("a", "02"), ("c", None), (None, "7f")}


def test_samples_with_missing_ids(spark):
    lines = [(None, "P1", i) for i in range(5)] + [(f"S{i}", "P1", i) for i in range(400)] + [(f"T{i}", None, i) for i in range(400)]
    shipments = spark.createDataFrame(lines, "shipment_id string, origin_port_id string, delay_days int").selectExpr(
        "*", "if(delay_days % 2 = 0, 1996, null) as departure_year", "'C1' as carrier_id", "cast(delay_days as double) as cost_usd"
    )
    carriers = spark.createDataFrame([("C1", "Air")], "carrier_id string, carrier_type string")
    ports = spark.createDataFrame([("P1", "ASIA")], "port_id string, region string")
    found = rows(dashboards.samples(shipments, carriers, ports, 9, written=True))
    assert found == rows(dashboards.samples(shipments, carriers, ports, 9)) and len(found) == 36
    assert len(rows(dashboards.samples(shipments, carriers, ports, 9, written=True).where("shipment_id is null"))) == 5


def test_states_of_parts_add_up(tables):
    shipments = tables["shipments"]
    for keys in ([], ["carrier_id"], ["departure_month"]):
        one = states.merged(states.state(shipments, ["carrier_id", "departure_month"]), keys)
        two = states.state(shipments, ["carrier_id", "departure_month"]).where("departure_year % 2 = 0")
        two = two.unionByName(states.state(shipments.where("departure_year % 2 = 1"), ["carrier_id", "departure_month"]))
        assert rows(one) == rows(states.merged(two, keys))


def test_a_delivery_of_one_year_rewrites_that_year(spark, tables, tmp_path):
    folder, shipments = str(tmp_path), tables["shipments"]
    files.write_parquet_tables({"carriers": tables["carriers"], "ports": tables["ports"]}, folder)
    etl.load_years(spark, shipments.where("departure_year <> 1997 or transit_days > 15"), folder)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    etl.load_years(spark, shipments.where("departure_year = 1997"), folder)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all(p.parent.name == "departure_year=1997" for p in changed)
    found = etl.read_states(spark, folder)
    for name, whole in etl.all_states(tables).items():
        assert rows(found[name].select(*whole.columns)) == rows(whole), name
    assert rows(states.carrier_kpis(found["carrier_state"], tables["carriers"])) == rows(
        marts.carrier_kpis(shipments, tables["carriers"])
    )
    assert rows(states.monthly_kpis(found["month_state"])) == rows(marts.monthly_kpis(shipments))


def test_dashboard_reads_no_shipment(spark, sf_dir, tmp_path):
    etl.run_etl(spark, registry.written_csvs(spark, sf_dir), str(tmp_path))
    relations = etl.read_tables(spark, str(tmp_path))
    assert relations["master"].columns == MASTER_COLUMNS
    found = dashboard.datasets(relations, [1996], ["ASIA"], ("Supplier#000000003", "Supplier#000000007"))
    assert not any("/master/" in p or "/shipments/" in p for df in found.values() for p in df.inputFiles())
    text = found["kpi_strip"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(departure_year" in text and "EqualTo(origin_region,ASIA)" in text


def test_a_reader_never_finds_nothing(spark):
    """What was opened before a load still reads the old rows, the name the new ones; older versions go."""

    def numbered(k):
        return {"carriers": spark.range(k).selectExpr("concat('C', id) as carrier_id", f"{k} as load")}

    spark.sql("create database gapless")
    try:
        files.save_tables(numbered(1), "gapless")
        opened = spark.table("gapless.carriers")
        during = []

        class Watched:
            """A writer that looks at the name between its write and the switch."""

            def __init__(self, writer):
                self.writer = writer

            def format(self, kind):
                self.writer.format(kind)
                return self

            def saveAsTable(self, name):
                self.writer.saveAsTable(name)
                during.append(spark.table("gapless.carriers").count())

        for k in (2, 3, 4):
            df = numbered(k)["carriers"]
            catalog.replace_table(Watched(df.write.mode("overwrite")), df.columns, spark, "carriers", "gapless")
            assert opened.count() == k - 1
            opened = spark.newSession().table("gapless.carriers")
            assert opened.count() == k
        assert during == [1, 2, 3] and len(catalog.versions(spark, "carriers", "gapless")) == catalog.KEPT_VERSIONS
    finally:
        spark.sql("drop database gapless cascade")


def test_a_plain_table_of_the_name_gives_way(spark):
    spark.sql("create database older")
    try:
        spark.range(3).write.saveAsTable("older.carriers")
        files.save_tables({"carriers": spark.range(5)}, "older")
        assert spark.table("older.carriers").count() == 5
        catalog.drop_table(spark, "carriers", "older")
        assert spark.catalog.listTables("older") == []
    finally:
        spark.sql("drop database older cascade")


def test_csv_files_are_shared_by_tasks_where_no_value_spans_lines(spark, tmp_path):
    folder = tmp_path / "x y.csv"
    folder.mkdir()
    plain = "".join(f'{k},"say ""hi"", {k}"\n' for k in range(20_000))
    (folder / "a.csv").write_text("k,v\n" + plain)
    (folder / "b.csv").write_text('k,v\n-1,"two\nlines"\n-2,"three\r\n\nlines, ""quoted"""\n')
    (folder / "c.csv").write_text("k,v\n")
    spans = {f.rpartition("/")[2]: odd for f, odd in files.spanning_files(spark, str(folder)).items()}
    assert spans == {"a.csv": False, "b.csv": True, "c.csv": False}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        df = files.read_csv(spark, str(folder))
        whole = files.read_csv(spark, str(folder), multiline=True)
        assert df.columns == ["k", "v"] and rows(df) == rows(whole) and df.count() == 20_002
        assert df.rdd.getNumPartitions() > 5 > whole.rdd.getNumPartitions()
        assert files.read_csv(spark, f"{folder}/a.csv").rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_board_sums_shipments_once(tables):
    board = states.board(tables["shipments"], tables["carriers"], tables["ports"])
    plan = board._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "SortMergeJoin" not in plan
