"""Reports from the parts' partials equal the reports over the opened tables, whatever was published before."""

import json

import pytest
from pyspark.sql import functions as F

from orderlake.config import materialize, scratch_path
from orderlake.operators import reports
from orderlake.plans import commits, partials, published_reports
from orderlake.plans.gold import star_schema
from orderlake.plans.publish import Warehouse, load_all, load_dimension, load_fact, manifest_entries, open_table
from orderlake.plans.versions import Parts
from orderlake.schemas import DIMENSIONS, GOLD_TABLES
from orderlake.sources.tables import sales_projection
from tests.conftest import SF_SMALL

OVER_TABLES = {
    "table_counts": lambda t: reports.table_counts(t),
    "revenue_by_region": lambda t: reports.revenue_by_region(t["fact_sales"], t["dim_region"]),
    "revenue_by_category_quarter": lambda t: reports.revenue_by_category_quarter(
        t["fact_sales"], t["dim_product"], t["dim_date"]),
    "return_rate_by_payment": lambda t: reports.return_rate_by_payment(t["fact_sales"], t["dim_payment"]),
}


@pytest.fixture(scope="module")
def star(spark):
    star = star_schema(materialize(sales_projection(spark, SF_SMALL), "bronze"))
    return {n: materialize(star[n].select(*GOLD_TABLES[n].column_names), n) for n in GOLD_TABLES}


class Before(Warehouse):
    """A warehouse with the same files under another commit log."""

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifest-before"


def _warehouse(spark, star, name):
    wh = Warehouse(scratch_path(spark, name))
    for n in DIMENSIONS:
        load_dimension(spark, wh, n, star[n], "dims")
    return wh


def _assert_equal(spark, wh, names=tuple(OVER_TABLES)):
    tables = {n: open_table(spark, wh, n) for n in GOLD_TABLES}
    for name in names:
        got, want = published_reports.REPORTS[name](spark, wh), OVER_TABLES[name](tables)
        assert got.columns == want.columns
        rows, wanted = [tuple(r) for r in got.collect()], [tuple(r) for r in want.collect()]
        assert sorted(rows) == sorted(wanted) if name == "table_counts" else rows == wanted, name


def test_changed_orders_and_replays(spark, star):
    """Newer versions, older ones, a run repeated with fewer rows, and one repeated with none."""
    wh = _warehouse(spark, star, "wh-partials")
    fact = star["fact_sales"]
    last = fact.agg(F.max("date_key")).first()[0]
    key = F.split("order_id", "-")[0].cast("long")
    newer = fact.withColumns({"date_key": F.lit(last), "total_amount": F.lit(0.1), "is_returned": F.lit(1),
                              "region_id": F.lit(0).cast("long")})
    load_fact(spark, wh, fact, "r1")
    load_fact(spark, wh, newer.where(key % 3 == 0), "r2")
    _assert_equal(spark, wh)
    load_fact(spark, wh, newer.where(key % 9 == 0), "r2")
    _assert_equal(spark, wh)
    load_fact(spark, wh, newer.where("false"), "r2")
    _assert_equal(spark, wh)
    assert Parts.of(manifest_entries(spark, wh), "fact_sales").shown == ["r1"]


def test_a_part_with_no_row_shown_and_null_keys_and_measures(spark, star):
    wh = _warehouse(spark, star, "wh-hidden")
    fact = star["fact_sales"].limit(40)
    last = star["fact_sales"].agg(F.max("date_key")).first()[0]
    fact = materialize(fact.withColumn("date_key", F.lit(star["fact_sales"].agg(F.min("date_key")).first()[0])), "forty")
    nulls = fact.withColumns({"date_key": F.lit(last), "region_id": F.lit(None).cast("long"),
                              "total_amount": F.lit(None).cast("double"), "profit_margin": F.lit(None).cast("double")})
    load_fact(spark, wh, fact, "r1")
    load_fact(spark, wh, nulls, "r2")
    assert Parts.of(manifest_entries(spark, wh), "fact_sales").shown == ["r2"]
    _assert_equal(spark, wh)
    assert published_reports.revenue_by_region(spark, wh).isEmpty()
    assert {r.revenue for r in published_reports.revenue_by_category_quarter(spark, wh).collect()} == {None}
    parts = Parts.of(manifest_entries(spark, wh), "fact_sales")
    assert parts.partials["r1"][1] == 0 and parts.partials["r2"][1] > 0
    load_fact(spark, wh, nulls.limit(7), "r2")  # 33 orders of r1 are shown again
    assert Parts.of(manifest_entries(spark, wh), "fact_sales").partials["r1"][1] > 0
    _assert_equal(spark, wh)


def test_partials_are_exact_after_many_changes(spark, star):
    """Taking rows out leaves no residue: the stored sums equal those of a single publish to the last decimal."""
    fact = star["fact_sales"]
    last = fact.agg(F.max("date_key")).first()[0]
    newer = fact.withColumns({"date_key": F.lit(last), "total_amount": F.col("total_amount") / 3})
    changed, once = (_warehouse(spark, star, n) for n in ("wh-many", "wh-once"))
    load_fact(spark, changed, fact, "r1")
    for every in (2, 3, 5):
        load_fact(spark, changed, newer.where(F.xxhash64("order_id") % every == 0), "r2")
    load_fact(spark, changed, newer.where("false"), "r2")
    load_fact(spark, once, fact, "r1")
    for grain in partials.KEYS:
        a, b = (published_reports.sums(spark, wh, grain) for wh in (changed, once))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), grain


def test_reports_open_no_file_of_the_fact(spark, star):
    wh = _warehouse(spark, star, "wh-files")
    load_fact(spark, wh, star["fact_sales"], "r1")
    load_fact(spark, wh, star["fact_sales"].limit(50).withColumn("total_amount", F.lit(5.5)), "r2")
    for name in ("revenue_by_region", "revenue_by_category_quarter", "return_rate_by_payment"):
        files = published_reports.REPORTS[name](spark, wh).inputFiles()
        of_fact = [f for f in files if "/fact_sales/" in f]
        assert of_fact and all("/fact_sales/partials/" in f for f in of_fact), name
    # A report reads its own grain only.
    plan = published_reports.sums(spark, wh, "region")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in plan and "product_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_parts_published_without_partials(spark, star):
    """A warehouse from before: its parts are aggregated when read, until their run is published again."""
    wh = _warehouse(spark, star, "wh-old")
    fact = star["fact_sales"]
    load_fact(spark, wh, fact, "r1")
    load_fact(spark, wh, fact.limit(60).withColumn("total_amount", F.lit(9.25)), "r2")
    old = Before(wh.root)
    seq = 0
    for tbl, run_id, path, rows, _, part in sorted(manifest_entries(spark, wh), key=lambda e: e[4]):
        if not tbl.endswith("/partials"):
            seq += 1
            commits.commit(spark, old.manifest, seq, [(tbl, run_id, path, rows, part)])
    assert Parts.of(manifest_entries(spark, old), "fact_sales").partials == {}
    _assert_equal(spark, old)
    last = fact.agg(F.max("date_key")).first()[0]
    load_fact(spark, old, fact.limit(20).withColumns({"date_key": F.lit(last), "total_amount": F.lit(1.25)}), "r3")
    assert list(Parts.of(manifest_entries(spark, old), "fact_sales").partials) == ["r3"]
    _assert_equal(spark, old)
    load_fact(spark, old, fact, "r1")
    assert sorted(Parts.of(manifest_entries(spark, old), "fact_sales").partials) == ["r1", "r3"]
    _assert_equal(spark, old)


def test_empty_fact_and_pointers_in_one_commit(spark, star):
    wh = Warehouse(scratch_path(spark, "wh-empty"))
    load_all(spark, wh, {**star, "fact_sales": star["fact_sales"].where("false")}, "r1")
    _assert_equal(spark, wh)
    load_fact(spark, wh, star["fact_sales"], "r2")
    lines = [json.loads(r.value) for r in spark.read.text(commits.commit_path(wh.manifest, 2)).collect()]
    assert {"fact_sales", "fact_sales/index", "fact_sales/partials"} == {line["tbl"] for line in lines}
