"""Publishing and idempotence: snapshot swap, replay-safe fact, gate, daily run."""

import pytest
from pyspark.sql import functions as F

from orderlake.config import scratch_path
from orderlake.operators.reports import table_counts
from orderlake.plans.daily_run import RunConfig, daily_run, quality_gate
from orderlake.plans.ddl import declare_gold, ddl_statements
from orderlake.plans.gold import star_schema
from orderlake.plans.publish import (
    Warehouse, current_versions, load_all, load_dimension, load_fact, manifest, open_table,
)
from orderlake.schemas import GOLD_TABLES
from orderlake.sources.csv import read_sales_csv, write_sales_csv
from orderlake.sources.eventlog import EventLog
from orderlake.sources.tables import sales_projection
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def star(spark):
    return star_schema(sales_projection(spark, SF_SMALL))


def test_fact_replay_and_correction(spark, star):
    wh = Warehouse(scratch_path(spark, "wh-test"))
    fact = star["fact_sales"]
    load_fact(spark, wh, fact, "r1")
    load_fact(spark, wh, fact, "r1")
    assert open_table(spark, wh, "fact_sales").count() == 5999
    changed = fact.limit(3).withColumn("quantity", F.lit(999))
    load_fact(spark, wh, changed, "r2")
    out = open_table(spark, wh, "fact_sales")
    assert out.count() == 5999
    assert out.where("quantity = 999").count() == 3


def test_dimension_swap_and_declared_table(spark, star):
    root = scratch_path(spark, "wh-ddl")
    declare_gold(spark, "orderlake_test", root)
    wh = Warehouse(root, database="orderlake_test")
    region = star["dim_region"]
    load_dimension(spark, wh, "dim_region", region.limit(2), "r1")
    assert spark.table("orderlake_test.dim_region").count() == 2
    load_dimension(spark, wh, "dim_region", region, "r2")
    assert _rows(spark.table("orderlake_test.dim_region")) == _rows(region)
    assert current_versions(spark, wh)["dim_region"][0] == "r2"
    info = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED orderlake_test.dim_region").collect()}
    assert info["Comment"] == "regions"
    spark.catalog.setCurrentDatabase("default")


def test_ddl_declares_every_table():
    stmts = ddl_statements("sales_dwh", "/x")
    assert stmts[0] == "CREATE DATABASE IF NOT EXISTS sales_dwh"
    assert sum(s.startswith("CREATE TABLE") for s in stmts) == 6
    assert any("customer_id VARCHAR(20) NOT NULL" in s for s in stmts)


def test_failed_gate_publishes_nothing(spark, star):
    wh = Warehouse(scratch_path(spark, "wh-gate"))
    tables = dict(star.tables)
    tables["fact_sales"] = tables["fact_sales"].withColumn("discount", F.lit(1.5))
    with pytest.raises(ValueError, match="quality gate"):
        load_all(spark, wh, tables, "r1", gate=quality_gate())
    assert manifest(spark, wh).count() == 0
    with pytest.raises(KeyError):
        open_table(spark, wh, "dim_region")


def test_daily_runs_are_incremental_and_repeatable(spark):
    root = scratch_path(spark, "daily-test")
    write_sales_csv(sales_projection(spark, SF_SMALL), f"{root}/csv")
    source = read_sales_csv(spark, f"{root}/csv")
    cfg = RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(f"{root}/wh"),
                    slice_rows=4000)
    r1 = daily_run(spark, cfg, "d1", source=source)
    r2 = daily_run(spark, cfg, "d2", source=source)
    again = daily_run(spark, cfg, "d2", source=source)  # retry of d2
    r3 = daily_run(spark, cfg, "d3", source=source)      # nothing left to send
    assert (r1.sent, r2.sent, again.sent, r3.sent) == (4000, 2000, 2000, 0)
    counts = dict(_rows(table_counts({n: open_table(spark, cfg.warehouse, n) for n in GOLD_TABLES})))
    assert counts == {"dim_customer": 150, "dim_date": 1084, "dim_payment": 5, "dim_product": 200,
                      "dim_region": 5, "fact_sales": 5999}
    fact = open_table(spark, cfg.warehouse, "fact_sales")
    assert fact.select("order_id").distinct().count() == 5999


def test_session_catalog_connector(spark, star):
    from orderlake.sources.warehouse import Connector, read_query, write_table

    root = scratch_path(spark, "conn")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS orderlake_conn LOCATION '{root}'")
    conn = Connector()
    write_table(star["dim_payment"], conn, "orderlake_conn.dim_payment_temp")
    got = read_query(spark, conn, "SELECT COUNT(*) AS n FROM orderlake_conn.dim_payment_temp "
                                  "WHERE payment_method LIKE '%URGENT%'").first()["n"]
    assert got == 1


def test_incremental_runs_equal_full_rebuild(spark):
    """Three daily runs, each reading only its new rows, publish what one full build computes."""
    root = scratch_path(spark, "incr-test")
    sales = sales_projection(spark, SF_SMALL)
    write_sales_csv(sales, f"{root}/csv")
    source = read_sales_csv(spark, f"{root}/csv")
    cfg = RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(f"{root}/wh"),
                    slice_rows=2500)
    for i in range(3):
        daily_run(spark, cfg, f"d{i}", source=source)
    full = star_schema(sales)
    for name in GOLD_TABLES:
        assert _rows(open_table(spark, cfg.warehouse, name)) == _rows(full[name].select(*GOLD_TABLES[name].column_names)), name


def test_daily_run_quarantines_rows_unfit_for_gold(spark):
    root = scratch_path(spark, "daily-bad")
    sales = sales_projection(spark, SF_SMALL).limit(50)
    bad = sales.limit(3).withColumn("order_date", F.lit("2024/01/15")).withColumn(
        "order_id", F.concat("order_id", F.lit("-bad")))
    cfg = RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(f"{root}/wh"))
    daily_run(spark, cfg, "d1", source=sales.unionByName(bad))
    q = spark.read.parquet(cfg.gold_quarantine)
    assert q.count() == 3 and {r[0] for r in q.select("reject_reason").collect()} == {"bad order_date"}
    assert open_table(spark, cfg.warehouse, "fact_sales").count() == sales.count()


def test_crash_between_write_and_publish_then_rerun_converges(spark, monkeypatch):
    import orderlake.plans.publish as pub

    root = scratch_path(spark, "crash-test")
    write_sales_csv(sales_projection(spark, SF_SMALL), f"{root}/csv")
    source = read_sales_csv(spark, f"{root}/csv")
    cfg = RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(f"{root}/wh"),
                    slice_rows=3000)
    daily_run(spark, cfg, "d1", source=source)
    before = open_table(spark, cfg.warehouse, "fact_sales").count()
    real_point = pub._point
    calls = {"n": 0}

    def crash_on_fact(spark_, wh, entries):
        if any(e[0] == "fact_sales" for e in entries):
            calls["n"] += 1
            raise RuntimeError("executor lost")  # dims re-pointed, fact written but not published
        return real_point(spark_, wh, entries)

    monkeypatch.setattr(pub, "_point", crash_on_fact)
    with pytest.raises(RuntimeError, match="executor lost"):
        daily_run(spark, cfg, "d2", source=source)
    monkeypatch.setattr(pub, "_point", real_point)
    assert open_table(spark, cfg.warehouse, "fact_sales").count() == before  # d2's fact not visible yet
    daily_run(spark, cfg, "d2", source=source)  # the retry converges
    fact = open_table(spark, cfg.warehouse, "fact_sales")
    assert fact.count() == fact.select("order_id").distinct().count() == 5999
    assert calls["n"] == 1


# ------------------------------------------------------------- corrections across runs

def _order(order_id, total, date="2024-01-05", **more):
    row = dict(order_id=order_id, customer_id="C1", product_id="P1", category="A", price=1.0, discount=0.1, quantity=1,
               payment_method="card", order_date=date, delivery_time_days=2, region="North", returned="No",
               total_amount=float(total), shipping_cost=0.5, profit_margin=0.25, customer_age=30, customer_gender="F")
    return {**row, **more}


def _sales(spark, *rows):
    from orderlake.schemas import SALES

    return spark.createDataFrame([tuple(r[f] for f in SALES.names) for r in rows], SALES)


def _daily(spark, name):
    root = scratch_path(spark, name)
    return RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(f"{root}/wh"))


def _rows_of(fact):
    return sorted((r.order_id, r.total_amount) for r in fact.collect())


def _published(spark, cfg):
    return _rows_of(open_table(spark, cfg.warehouse, "fact_sales"))


def _versions(spark, *rows):
    """The fact of one run, with its ordering tuple."""
    from orderlake.operators.fact import build_fact_sales

    region = spark.createDataFrame([(0, "North"), (1, "South")], "region_id long, region_name string")
    payment = spark.createDataFrame([(0, "card")], "payment_id long, payment_method string")
    return build_fact_sales(_sales(spark, *rows).coalesce(1), region, payment, 2, 1, keep_state=True)


CORRECTIONS = {
    "whole run superseded": [[("o1", 10)], [("o1", 20)]],
    "part of a run superseded": [[("o1", 10), ("o2", 11)], [("o1", 20), ("o3", 5)]],
    "older version arrives later": [[("o1", 20, "2024-02-01")], [("o1", 30, "2024-01-01"), ("o4", 1)]],
    "three versions": [[("o1", 10)], [("o1", 30), ("o2", 2)], [("o1", 20), ("o2", 3)]],
}


@pytest.mark.parametrize("case", sorted(CORRECTIONS))
def test_corrections_equal_one_build(spark, case):
    wh = Warehouse(scratch_path(spark, "corrections"))
    runs = [[_order(*r) for r in run] for run in CORRECTIONS[case]]
    for i, rows in enumerate(runs):
        load_fact(spark, wh, _versions(spark, *rows), f"r{i}")
    whole = _rows_of(_versions(spark, *[r for rows in runs for r in rows]))
    assert _rows_of(open_table(spark, wh, "fact_sales")) == whole
    load_fact(spark, wh, _versions(spark, *runs[0]), "r0")  # an earlier run repeated after a later one
    assert _rows_of(open_table(spark, wh, "fact_sales")) == whole


def test_readers_see_whole_versions_between_steps(spark, monkeypatch):
    """Whatever a publish has written, the published fact is the old one until the pointers move."""
    import orderlake.plans.publish as pub

    wh = Warehouse(scratch_path(spark, "readers"))
    load_fact(spark, wh, _versions(spark, _order("o1", 10), _order("o2", 11)), "r1")
    seen = []
    for step in ("stage_fact", "merge_fact", "_point"):
        real = getattr(pub, step)

        def watched(*a, _real=real, **k):
            before = _rows_of(open_table(spark, wh, "fact_sales"))
            out = _real(*a, **k)
            seen.append((before, _rows_of(open_table(spark, wh, "fact_sales"))))
            return out

        monkeypatch.setattr(pub, step, watched)
    pub.load_fact(spark, wh, _versions(spark, _order("o1", 20)), "r2")
    old, new = [("o1", 10.0), ("o2", 11.0)], [("o1", 20.0), ("o2", 11.0)]
    assert seen == [(old, old), (old, old), (old, new)]


def test_run_after_failed_gate_takes_its_orders_along(spark):
    cfg = _daily(spark, "failed-gate")
    strict = RunConfig(cfg.log, cfg.lake_root, cfg.warehouse)
    import orderlake.plans.daily_run as dr

    real = dr.load_all
    dr.load_all = lambda *a, **k: (_ for _ in ()).throw(ValueError("quality gate failed"))
    try:
        with pytest.raises(ValueError, match="gate"):
            daily_run(spark, strict, "r1", source=_sales(spark, _order("o1", 1), _order("o2", 2)))
    finally:
        dr.load_all = real
    daily_run(spark, cfg, "r2", source=_sales(spark, _order("o3", 3)))
    assert _published(spark, cfg) == [("o1", 1.0), ("o2", 2.0), ("o3", 3.0)]


def test_rows_breaking_declared_rules_are_diverted(spark):
    cfg = _daily(spark, "diverted")
    rows = [_order("o1", 1), _order("o2", 2, discount=1.5), _order("o" * 21, 3), _order("o4", 4, region="r" * 51)]
    daily_run(spark, cfg, "r1", source=_sales(spark, *rows))
    assert _published(spark, cfg) == [("o1", 1.0)]
    reasons = {r.reject_reason for r in spark.read.parquet(cfg.gold_quarantine).collect()}
    assert reasons == {"discount outside 0.0 to 1.0", "order_id longer than 20", "region longer than 50"}


def test_declared_fact_is_filled(spark):
    root = scratch_path(spark, "declared-fact")
    declare_gold(spark, "orderlake_fact", root)
    cfg = RunConfig(EventLog("files", path=f"{root}/log"), f"{root}/lake", Warehouse(root, database="orderlake_fact"))
    daily_run(spark, cfg, "r1", source=_sales(spark, _order("o1", 10), _order("o2", 11, region="South")))
    daily_run(spark, cfg, "r2", source=_sales(spark, _order("o1", 20)))
    got = spark.sql("SELECT r.region_name, COUNT(f.order_id) AS n, SUM(f.total_amount) AS s FROM orderlake_fact.fact_sales f "
                    "JOIN orderlake_fact.dim_region r ON f.region_id = r.region_id GROUP BY r.region_name").collect()
    assert sorted(tuple(r) for r in got) == [("North", 1, 20.0), ("South", 1, 11.0)]
    spark.catalog.setCurrentDatabase("default")


def test_publish_to_connector(spark):
    from orderlake.plans.publish import publish_to_connector
    from orderlake.sources.warehouse import Connector

    cfg = _daily(spark, "connector")
    daily_run(spark, cfg, "r1", source=_sales(spark, _order("o1", 10)))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS orderlake_out LOCATION '{scratch_path(spark, 'out')}'")
    sent = publish_to_connector(spark, cfg.warehouse, Connector(), "orderlake_out.")
    assert sent["fact_sales"] == 1 and spark.table("orderlake_out.fact_sales").first().total_amount == 10.0
    assert spark.table("orderlake_out.dim_region").count() == 1
