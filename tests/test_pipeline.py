import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from comanda.operators import catalog, cubes, marts, quality
from comanda.plans import graph_export
from comanda.plans.pipeline import PipelineConfig, document_store, run_pipeline
from comanda.plans.registry import star
from comanda.plans.star import StoredStar
from comanda.sinks import tables as sink
from comanda.sinks.files import write_parquet
from comanda.sinks.jdbc import write_options
from comanda.sinks.parts import PartStore
from comanda.sources.graph_csv import read_graph_file, to_typed
from comanda.sources.jdbc import JdbcConfig, read_options
from comanda.sources.testdata import operational_tables
from tests.conftest import SF_DIR

NAMES = ["categories", "restaurants", "products", "users", "couriers", "orders", "order_items", "deliveries"]


def rows(df):
    return sorted(map(str, df.collect()))


def config(spark, t, folder, **kwargs):
    serving = f"{folder}/serving"
    return PipelineConfig(
        read_source=lambda name: getattr(t, name),
        write_serving=lambda df, name: write_parquet(df, f"{serving}/{name}"),
        read_serving=lambda name: spark.read.parquet(f"{serving}/{name}"),
        zones=t.zones, staging_dir=f"{folder}/staging", state_dir=f"{folder}/state", tables=NAMES, **kwargs,
    )


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    t = operational_tables(spark, SF_DIR, item_ids=True)
    conf = config(spark, t, folder, database="dw", min_orders=1000)
    first = run_pipeline(spark, conf)
    star_ = StoredStar(spark, "dw")
    before = {name: rows(star_.table(name)) for name in ("fact_orders", "fact_order_items", "mart_trends")}
    second = run_pipeline(spark, conf)
    return conf, first, second, before


def test_second_run_gives_the_same_tables(spark, run):
    conf, first, second, before = run
    assert first["documents_refreshed"] == 1 and second["documents_refreshed"] == 0  # 200 products are one range of ids
    assert {k: v for k, v in first.items() if k in ("extracted", "warehouse", "marts")} == \
        {k: v for k, v in second.items() if k in ("extracted", "warehouse", "marts")}
    star_ = StoredStar(spark, "dw")
    assert before == {name: rows(star_.table(name)) for name in before}
    assert first["warehouse"]["fact_orders"] == 1500 and first["warehouse"]["dim_time"] == 24
    assert len(first["exported"]) == 10


def test_stored_and_lazy_star_agree(spark, run):
    lazy, stored = star(spark, SF_DIR), StoredStar(spark, "dw")
    for build in [*cubes.CUBES.values(), *marts.MARTS.values(), marts.executive_summary]:
        assert rows(build(lazy)) == rows(build(stored).select(*build(lazy).columns))


def test_served_marts(spark, run):
    conf, *_ = run
    served = conf.read_serving("mart_revenue_by_cat")
    assert rows(served) == rows(cubes.revenue_month_category(StoredStar(spark, "dw")).select(*served.columns))
    documents = document_store(spark, conf).read()
    assert documents.select("_source.id").distinct().count() == documents.count() == 200


def test_filter_on_a_cube_prunes_partitions(spark, run):
    cube = cubes.order_status(StoredStar(spark, "dw")).filter("year = 1996 AND month = 5")
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1996" in plan.split("PartitionFilters")[1]


def test_comments_are_kept(spark, run):
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE dw.dim_date").collect()}
    assert described["date_key"] == "yyyyMMdd"


def test_replace_partitions_leaves_other_months(spark, run):
    total = spark.table("dw.fact_orders").count()
    month = spark.table("dw.fact_orders").filter("year = 1996 AND month = 5")
    kept = spark.createDataFrame(month.limit(1).collect(), month.schema)
    n = month.count()
    assert n > 1
    sink.replace_partitions(kept, "dw", "fact_orders")
    assert spark.table("dw.fact_orders").count() == total - n + 1


def test_ddl(spark, tmp_path):
    for _ in range(2):
        sink.create_warehouse(spark, "empty_dw", str(tmp_path / "empty_dw"))
    def stored():
        return spark.sql("SHOW TABLES IN empty_dw").filter("NOT isTemporary").count()

    assert stored() == 10
    assert sink.preview(spark, "empty_dw", "fact_orders").count() == 0
    sink.drop_table(spark, "empty_dw", "dim_time")
    assert stored() == 9


def test_cubes_are_views_for_sql(spark, run):
    orders = spark.table("dw.fact_orders").count()  # another test reloads a month
    assert spark.sql("SELECT sum(order_count) AS n FROM cube_order_status").first().n == orders
    assert spark.sql("SELECT * FROM cube_peak_hours WHERE hour = 9").count() == 7


@pytest.mark.parametrize("name", list(cubes.CUBES))
def test_catalogue_views_give_the_cubes_rows(spark, run, name):
    """Another session reads the views; their rows, names and types are those of the cubes."""
    other = spark.newSession()
    view, cube = other.table(f"dw.{name}"), cubes.CUBES[name](StoredStar(spark, "dw"))
    assert view.columns == cube.columns and [t for _, t in view.dtypes] == [t for _, t in cube.dtypes]
    assert rows(view) == rows(cube) and view.count() > 0
    assert other.sql(f"SHOW CREATE TABLE dw.{name}").first()[0].startswith("CREATE VIEW")


def test_views_follow_the_tables_and_prune_them(spark, run):
    view = spark.newSession().sql("SELECT * FROM dw.cube_order_status WHERE year = 1996 AND month = 5")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1996" in plan.split("PartitionFilters")[1]
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.newSession().table("cube_order_status")  # the bare names are the session's


def test_quality_runs_after_a_failure(spark, small, tmp_path):
    conf = config(spark, small, str(tmp_path), database="dw_small", min_orders=1000)
    with pytest.raises(quality.QualityError, match="fewer than 1000 orders"):
        run_pipeline(spark, conf)
    run_pipeline(spark, config(spark, small, str(tmp_path), database="dw_small", min_orders=6))

    def broken(name):
        raise RuntimeError("source is down")

    with pytest.raises(RuntimeError, match="source is down"):
        run_pipeline(spark, PipelineConfig(**{**conf.__dict__, "read_source": broken}))


def test_catalogue_digest(spark, small):
    digest = catalog.fingerprint(small.products).first().digest
    assert catalog.fingerprint(small.products.repartition(3)).first().digest == digest
    for change in ("price + 0.01", "NULL"):
        dearer = small.products.selectExpr("id", "name", f"CAST({change} AS DOUBLE) price", "available", "category_id")
        assert catalog.fingerprint(dearer).first().digest != digest


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*") if p.is_file() and p.name[0] not in "._"}


def test_one_price_rewrites_one_range(spark, tmp_path):
    """Documents of ids 0 to 99 in ranges of 16; one price changes, a range goes, another comes."""
    store = PartStore(spark, str(tmp_path), "json")
    documents = spark.range(100).selectExpr("id", "concat('p', id) AS name", "id / 4 AS price", "true AS available", "'c' AS category")
    assert store.version() == 0 and store.manifest().count() == 0
    assert catalog.refresh(documents, store, bits=4) == 7 and store.read().count() == 100
    before = files(tmp_path)
    assert catalog.refresh(documents.repartition(3), store, bits=4) == 0 and files(tmp_path) == before

    dearer = documents.withColumn("price", F.when(F.col("id") == 37, 99.0).otherwise(F.col("price")))
    assert catalog.refresh(dearer, store, bits=4) == 1 and store.version() == 2
    after = files(tmp_path)
    assert before.items() <= after.items()
    assert {name.split("/")[2] for name in after.keys() - before.keys() if name.startswith("data/")} == {"_part=2"}
    assert store.manifest().filter("version = 2").count() == 1
    assert rows(store.read().select("_id", "_source.price")) == rows(dearer.selectExpr("id AS _id", "price"))

    moved = dearer.filter("id < 80 OR id >= 96").union(dearer.filter("id = 5").withColumn("id", F.lit(200).cast("long")))
    assert catalog.refresh(moved, store, bits=4) == 2  # ids 80 to 95 are gone, 200 is new
    assert rows(store.read().select("_id")) == rows(moved.selectExpr("id AS _id"))
    assert catalog.refresh(moved.limit(0), store, bits=4) == 7 and store.read().count() == 0


def test_digests_add_up(spark, small):
    """The leaves of the tree, at any width, add up to the same root."""
    documents = catalog.search_documents(small.products, small.categories)
    total = lambda bits: catalog.range_digests(documents, bits).agg(
        F.sum("documents"), F.sum("head"), F.sum("tail")).first()
    assert total(0) == total(4) == total(60) and total(0)[0] == 3


def test_merge_rewrites_only_touched_parts(spark, tmp_path):
    store = PartStore(spark, str(tmp_path), parts=8)
    assert store.merge(spark.createDataFrame([], "src long, dst long, km double, at int"), ["src", "dst"], ["at"]) == []
    first = spark.range(200).selectExpr("id AS src", "id % 7 AS dst", "0.5D AS km", "1 AS at")
    assert store.merge(first, ["src", "dst"], ["at"]) == list(range(8)) and store.read().count() == 200
    before = files(tmp_path)
    news = spark.createDataFrame([(3, 3, 7.0, 2), (3, 3, 9.0, 1), (999, 1, 1.0, 1)], "src long, dst long, km double, at int")
    touched = store.merge(news, ["src", "dst"], ["at"])
    after = files(tmp_path)
    assert 1 <= len(touched) <= 2 and before.items() <= after.items()
    assert {int(name.split("/")[2][6:]) for name in after.keys() - before.keys() if name.startswith("data/")} == set(touched)
    merged = {(r.src, r.dst): r.km for r in store.read().collect()}
    assert len(merged) == 201 and merged[3, 3] == 7.0 and merged[999, 1] == 1.0 and merged[4, 4] == 0.5
    read = store.read(parts=touched)
    assert read.count() == store.manifest().filter(F.col("_part").isin(touched)).agg(F.sum("rows")).first()[0]
    assert "PartitionFilters" in read._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="another number of parts"):
        PartStore(spark, str(tmp_path), parts=9).merge(news, ["src", "dst"], ["at"])


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    store = PartStore(spark, str(tmp_path), parts=4)
    store.merge(spark.createDataFrame([(1, 1)], "k long, v long"), ["k"], ["v"])

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", broken)  # the version is written last
        with pytest.raises(RuntimeError, match="lost"):
            store.merge(spark.createDataFrame([(1, 2), (2, 2)], "k long, v long"), ["k"], ["v"])
    assert store.version() == 1 and [tuple(r) for r in store.read().collect()] == [(1, 1)]
    store.merge(spark.createDataFrame([(1, 3)], "k long, v long"), ["k"], ["v"])
    assert store.version() == 2 and [tuple(r) for r in store.read().collect()] == [(1, 3)]


def test_graph_merged_into_stored_tables(spark, small, tmp_path):
    folder, store = str(tmp_path / "files"), str(tmp_path / "graph")
    graph_export.export_graph(small, folder)
    graph_export.merge_graph(spark, folder, store, parts=4)
    loaded = graph_export.load_graph(spark, folder)
    stored = graph_export.stored_graph(spark, store, parts=4)
    for name, df in loaded.items():
        assert rows(stored[name].read().select(*df.columns)) == rows(df), name


def test_graph_files(spark, small, tmp_path):
    folder = str(tmp_path / "graph")
    written = graph_export.export_graph(small, folder)
    loaded = graph_export.load_graph(spark, folder)
    assert written["order_items"] == 9 and set(written) == set(loaded)
    for name, df in graph_export.extracts(small).items():
        assert rows(read_graph_file(spark, folder, name).select(*df.columns)) == rows(df), name
        if name != "order_items":  # one of its lines repeats a product of the order
            assert rows(loaded[name].select(*df.columns)) == rows(df), name
    lines = {(r.order_id, r.prod_id): r.line_total for r in loaded["order_items"].collect()}
    assert len(lines) == 8 and lines[100, 10] == 10.0
    before = spark.createDataFrame([(7, "Old", "moto", "z1"), (99, "Kept", "moto", "z1")], loaded["couriers"].schema)
    again = graph_export.load_graph(spark, folder, {"couriers": before})["couriers"]
    assert {r.courier_id: r.name for r in again.collect()} == {7: "C7", 8: "C8", 99: "Kept"}


def test_empty_text_becomes_null(spark):
    raw = spark.createDataFrame([("", "7"), ("1.5", "x")], "lat string, n string")
    assert [tuple(r) for r in to_typed(raw, {"lat": "double", "n": "int"}).collect()] == [(None, 7), (1.5, None)]


def test_jdbc_options():
    conf = JdbcConfig("jdbc:postgresql://host/db", "u", "secret")
    assert "secret" not in repr(conf)
    assert read_options(conf, table="orders")["dbtable"] == "orders"
    assert read_options(conf, query="SELECT 1")["query"] == "SELECT 1"
    split = read_options(conf, query="SELECT * FROM orders", partition=("id", 1, 100, 8))
    assert split["dbtable"] == "(SELECT * FROM orders) AS pushed" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")
    with pytest.raises(ValueError):
        read_options(conf)
    options = write_options(conf, "mart_trends")
    assert options["truncate"] == "true" and options["dbtable"] == "mart_trends"
