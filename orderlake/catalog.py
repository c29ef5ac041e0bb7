"""The query catalogue: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables (or data Spark derives from them) whole.
Names and output columns match ``orderlake.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.config import materialize, scratch_path
from orderlake.functions.codec import decode_events
from orderlake.operators import quality, reports
from orderlake.operators.dedupe import latest_per_key
from orderlake.operators.fact import build_fact_sales
from orderlake.operators.joins import lookup_key
from orderlake.operators.keys import update_key_map
from orderlake.operators.slicing import positional_slice, produce_batch
from orderlake.plans import published_reports
from orderlake.plans.daily_run import RunConfig, daily_run
from orderlake.plans.gold import star_schema
from orderlake.plans.publish import Warehouse, load_all, load_dimension, load_fact, open_table, write_table
from orderlake.schemas import GOLD_TABLES, SALES_COLUMNS
from orderlake.sources.csv import read_sales_csv, write_sales_csv
from orderlake.sources.eventlog import EventLog, peek_events, publish_events, read_events, write_event_files
from orderlake.sources.faults import damage_csv, damage_events, order_key
from orderlake.sources.tables import read_table, sales_projection
from orderlake.streaming.ingest import IngestPaths, ingest, read_bronze, read_quarantine
from orderlake.streaming.ledger import Ledger, claim, ingest_capped

Query = Callable[[SparkSession, str], DataFrame]


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales projection materialised once, as the bronze table it stands for."""
    return materialize(sales_projection(spark, sf_dir), "bronze")


def _gold(spark: SparkSession, sf_dir: str, sort_dates: bool = False, reuse: bool = True):
    """Star schema over the sales projection; ``reuse`` stores its valid rows first
    (worth it when several gold tables read them, as the fact and reports do)."""
    return star_schema(sales_projection(spark, sf_dir), sort_dates=sort_dates, store=reuse)


def q_sales_projection(spark, sf_dir):
    return sales_projection(spark, sf_dir)


def _dim(name: str, sort_dates: bool = False) -> Query:
    def q(spark, sf_dir):
        return _gold(spark, sf_dir, sort_dates, reuse=name == "fact_sales")[name]
    q.__name__ = f"q_{name}"
    return q


def q_latest_per_key(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_table_counts(spark, sf_dir):
    return reports.table_counts(_gold(spark, sf_dir).tables)


def q_revenue_by_region(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return reports.revenue_by_region(g["fact_sales"], g["dim_region"])


def q_revenue_by_category_quarter(spark, sf_dir):
    g = _gold(spark, sf_dir)
    dim_product, dim_date = g.materialized("dim_product"), g.materialized("dim_date")
    return reports.revenue_by_category_quarter(g["fact_sales"], dim_product, dim_date,
                                               g.known_rows["dim_product"], g.known_rows["dim_date"])


def q_return_rate_by_payment(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return reports.return_rate_by_payment(g["fact_sales"], g["dim_payment"])


def queries() -> dict[str, Query]:
    return {**_core(), **STREAM_QUERIES, **GOLD_QUERIES}


def _core() -> dict[str, Query]:
    return {
        "sales_projection": q_sales_projection,
        "dim_customer": _dim("dim_customer"),
        "dim_product": _dim("dim_product"),
        "dim_date": _dim("dim_date", sort_dates=True),
        "dim_region": _dim("dim_region"),
        "dim_payment": _dim("dim_payment"),
        "latest_per_key": q_latest_per_key,
        "fact_sales": _dim("fact_sales"),
        "table_counts": q_table_counts,
        "revenue_by_region": q_revenue_by_region,
        "revenue_by_category_quarter": q_revenue_by_category_quarter,
        "return_rate_by_payment": q_return_rate_by_payment,
    }


# ---------------------------------------------------------------- sources & streams

# Producer runs of the resume query: each sends this part of the source.
RESUME_RUNS = 3


def _paths(root: str) -> IngestPaths:
    return IngestPaths(f"{root}/bronze", f"{root}/quarantine", f"{root}/_checkpoint")


def q_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv") + "/sales"
    write_sales_csv(sales_projection(spark, sf_dir), path)
    return read_sales_csv(spark, path)


def q_json_round_trip(spark, sf_dir):
    log = EventLog("files", path=scratch_path(spark, "events"))
    publish_events(sales_projection(spark, sf_dir), log)
    return decode_events(read_events(spark, log)).select(*SALES_COLUMNS)


def q_bounded_slice(spark, sf_dir):
    return positional_slice(sales_projection(spark, sf_dir), "order_id", 500, 500)


def q_peek_events(spark, sf_dir):
    log = EventLog("files", path=scratch_path(spark, "events"))
    publish_events(sales_projection(spark, sf_dir), log)
    return peek_events(spark, log, 5)


def q_stream_ingest_dedup(spark, sf_dir):
    """Three hash slices published, the first one redelivered; ingest keeps one copy of each event."""
    root = scratch_path(spark, "ingest")
    log = EventLog("files", path=f"{root}/log")
    sales = bronze_table(spark, sf_dir).withColumn("_slice", F.pmod(F.xxhash64("order_id"), F.lit(3)))
    for s in (0, 1, 2, 0):
        publish_events(sales.where(F.col("_slice") == s).drop("_slice"), log)
    paths = _paths(root)
    ingest(spark, log, paths, max_per_trigger=8)
    return read_bronze(spark, paths.bronze)


def q_stream_quarantine(spark, sf_dir):
    root = scratch_path(spark, "quarantine")
    log = EventLog("files", path=f"{root}/log")
    write_event_files(damage_events(sales_projection(spark, sf_dir)), log.path)
    paths = _paths(root)
    ingest(spark, log, paths)
    return read_quarantine(spark, paths.quarantine).select("order_id", "reject_reason")


def q_incremental_resume(spark, sf_dir):
    """Producer runs resume from the control table; each run is followed by an ingest run."""
    root = scratch_path(spark, "resume")
    write_sales_csv(sales_projection(spark, sf_dir), f"{root}/source_csv")
    source = read_sales_csv(spark, f"{root}/source_csv")
    log = EventLog("files", path=f"{root}/log")
    paths = _paths(root)
    run, slice_rows = 0, -(-source.count() // RESUME_RUNS)
    while True:
        sent = produce_batch(spark, source, "order_id", slice_rows, f"{root}/_control",
                             "sales_csv", f"run-{run}", lambda b: publish_events(b, log))
        ingest(spark, log, paths)
        run += 1
        if sent == 0:
            break
    return read_bronze(spark, paths.bronze)


def q_csv_dirty(spark, sf_dir):
    """A CSV file with mistyped fields, sent and ingested: each line is in bronze (no reason) or in quarantine."""
    root = scratch_path(spark, "dirty")
    write_sales_csv(damage_csv(sales_projection(spark, sf_dir)), f"{root}/source_csv")
    log = EventLog("files", path=f"{root}/log")
    publish_events(read_sales_csv(spark, f"{root}/source_csv", keep_corrupt=True), log)
    paths = _paths(root)
    ingest(spark, log, paths)
    good = read_bronze(spark, paths.bronze).select("order_id", F.lit(None).cast("string").alias("reject_reason"))
    return good.unionByName(read_quarantine(spark, paths.quarantine).select("order_id", "reject_reason"))


def q_capped_resume(spark, sf_dir):
    """Runs under a hard cap of records: the first one fails after its claim and is repeated when more has arrived."""
    root = scratch_path(spark, "capped")
    sales = bronze_table(spark, sf_dir)
    late = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    log = EventLog("files", path=f"{root}/log")
    publish_events(sales.where(~late), log)
    paths, ledger = _paths(root), Ledger(f"{root}/_ledger")
    cap = -(-sales.count() // RESUME_RUNS)
    claim(spark, log, ledger, "run-0", cap)
    publish_events(sales.where(late), log)
    run = 0
    while ingest_capped(spark, log, paths, ledger, f"run-{run}", cap):
        run += 1
    return read_bronze(spark, paths.bronze)


STREAM_QUERIES = {
    "csv_round_trip": q_csv_round_trip,
    "json_round_trip": q_json_round_trip,
    "bounded_slice": q_bounded_slice,
    "peek_events": q_peek_events,
    "stream_ingest_dedup": q_stream_ingest_dedup,
    "stream_quarantine": q_stream_quarantine,
    "incremental_resume": q_incremental_resume,
    "csv_dirty": q_csv_dirty,
    "capped_resume": q_capped_resume,
}


# ---------------------------------------------------------------- gold, quality, publish

# Planted-fault rules for the quality checks (modulus on the order key).
NULL_REGION_EVERY = 10
NULL_CUSTOMER_EVERY = 101
BAD_DISCOUNT_EVERY = 103
REPEATED_ORDER_EVERY = 107
ORPHAN_PRODUCT_EVERY = 109
# Incremental steps split orders by date: orders before this date arrive first.
FIRST_STEP_BEFORE = "1998-01-01"


def q_fact_null_fk(spark, sf_dir):
    sales = bronze_table(spark, sf_dir)
    sales = sales.withColumn("region", F.when(order_key() % NULL_REGION_EVERY == 0, F.lit(None))
                             .otherwise(F.col("region")))
    return star_schema(sales)["fact_sales"]


def faulted_gold(spark, sf_dir) -> dict[str, DataFrame]:
    """Gold built the reference's way (no validation, every bronze row kept) from
    damaged sales, then a fact loaded against stale product keys."""
    sales = bronze_table(spark, sf_dir)
    k = order_key()
    sales = (sales
             .withColumn("customer_id", F.when(k % NULL_CUSTOMER_EVERY == 0, F.lit(None))
                         .otherwise(F.col("customer_id")))
             .withColumn("discount", F.when(k % BAD_DISCOUNT_EVERY == 0, F.lit(1.5))
                         .otherwise(F.col("discount"))))
    sales = sales.unionByName(sales.where(k % REPEATED_ORDER_EVERY == 0))
    star = star_schema(sales, validate=False, dedupe=False)
    tables = dict(star.tables)
    fk = order_key("order_id")
    tables["fact_sales"] = tables["fact_sales"].withColumn(
        "product_id", F.when(fk % ORPHAN_PRODUCT_EVERY == 0, F.concat("product_id", F.lit("-x")))
        .otherwise(F.col("product_id")))
    return tables


def _dq(kind: str) -> Query:
    def q(spark, sf_dir):
        return quality.run_checks(faulted_gold(spark, sf_dir), (kind,))
    q.__name__ = f"q_dq_{kind}"
    return q


def q_dim_incremental_keys(spark, sf_dir):
    path = scratch_path(spark, "keymap")
    sales = bronze_table(spark, sf_dir)
    first = sales.where(F.col("order_date") < FIRST_STEP_BEFORE).select("customer_id")
    update_key_map(spark, path, first, "customer_id", "customer_key")
    return update_key_map(spark, path, sales.select("customer_id"), "customer_id", "customer_key")


# A customer who gets every third order, and orders without a customer (moduli on the order key).
HOT_CUSTOMER, HOT_EVERY = "C1", 3


def q_lookup_hot_names(spark, sf_dir):
    """Customers looked up in a dimension taken as too large to broadcast; one of them has a third of all rows."""
    gold = _gold(spark, sf_dir)
    k = order_key()
    orders = sales_projection(spark, sf_dir).select("order_id", F.when(k % NULL_CUSTOMER_EVERY == 0, F.lit(None)).when(
        k % HOT_EVERY == 0, F.lit(HOT_CUSTOMER)).otherwise(F.col("customer_id")).alias("customer_id"))
    return lookup_key(orders, gold["dim_customer"], "customer_id", "customer_id", "customer_gender", max_rows=0)


def q_fact_replay(spark, sf_dir):
    """Two runs (orders before / from the cut date), the second one replayed."""
    wh = Warehouse(scratch_path(spark, "wh"))
    sales = bronze_table(spark, sf_dir)
    star = star_schema(sales, key_maps={"dim_region": wh.key_map("dim_region"),
                                        "dim_payment": wh.key_map("dim_payment")})
    fact = star["fact_sales"].withColumn("_first", F.col("date_key") < int(FIRST_STEP_BEFORE.replace("-", "")))
    load_fact(spark, wh, fact.where("_first"), "run-1")
    load_fact(spark, wh, fact.where(~F.col("_first")), "run-2")
    load_fact(spark, wh, fact.where(~F.col("_first")), "run-2")
    return open_table(spark, wh, "fact_sales")


# Corrections sent by a second run (modulus on the order key, date and amount of the version).
OLDER_EVERY, OLDER_VERSION = 7, ("1990-01-01", -1.0)
NEWER_EVERY, NEWER_VERSION = 11, ("2030-01-01", 1.0)


def q_fact_corrections(spark, sf_dir):
    """All orders, then older and newer versions of some of them, then the first run replayed."""
    wh = Warehouse(scratch_path(spark, "wh"))
    sales = bronze_table(spark, sf_dir)

    def versions(every, version):
        return (sales.where(order_key() % every == 0)
                .withColumns({"order_date": F.lit(version[0]), "total_amount": F.lit(version[1])}))

    star = star_schema(sales, store=False)  # only the two key dimensions are built
    region, payment = star["dim_region"], star["dim_payment"]
    n_region, n_payment = region.count(), payment.count()

    def load(rows, run_id):
        load_fact(spark, wh, build_fact_sales(rows, region, payment, n_region, n_payment, keep_state=True), run_id)

    load(sales, "run-1")
    load(versions(OLDER_EVERY, OLDER_VERSION).unionByName(versions(NEWER_EVERY, NEWER_VERSION)), "run-2")
    load(sales, "run-1")
    return open_table(spark, wh, "fact_sales")


# A repeated run sends fewer of its newer versions, and none of its older ones.
REPEATED_EVERY = 22


def q_fact_changed_replay(spark, sf_dir):
    """All orders, then newer versions of some; then that run repeated with fewer: the others' first versions are back."""
    wh = Warehouse(scratch_path(spark, "wh"))
    sales = bronze_table(spark, sf_dir)
    star = star_schema(sales, store=False)  # only the two key dimensions are built
    region, payment = star["dim_region"], star["dim_payment"]
    n_region, n_payment = region.count(), payment.count()

    def newer(every):
        rows = sales.where(order_key() % every == 0).withColumns(
            {"order_date": F.lit(NEWER_VERSION[0]), "total_amount": F.lit(NEWER_VERSION[1])})
        return build_fact_sales(rows, region, payment, n_region, n_payment, keep_state=True)

    load_fact(spark, wh, build_fact_sales(sales, region, payment, n_region, n_payment, keep_state=True), "run-1")
    load_fact(spark, wh, newer(NEWER_EVERY), "run-2")
    load_fact(spark, wh, newer(REPEATED_EVERY), "run-2")
    return open_table(spark, wh, "fact_sales")


def q_reports_incremental(spark, sf_dir):
    """The changed replay of ``fact_changed_replay``, then the reports from the parts' partials, one below the other."""
    wh = Warehouse(scratch_path(spark, "wh"))
    sales = bronze_table(spark, sf_dir)
    star = star_schema(sales)
    load_all(spark, wh, star.tables, "run-1")
    region, payment = (open_table(spark, wh, n) for n in ("dim_region", "dim_payment"))
    n_region, n_payment = region.count(), payment.count()

    def newer(every):
        rows = sales.where(order_key() % every == 0).withColumns(
            {"order_date": F.lit(NEWER_VERSION[0]), "total_amount": F.lit(NEWER_VERSION[1])})
        return build_fact_sales(rows, region, payment, n_region, n_payment, keep_state=True)

    load_fact(spark, wh, newer(NEWER_EVERY), "run-2")
    load_fact(spark, wh, newer(REPEATED_EVERY), "run-2")

    def lines(report, name, year=None, quarter=None, orders="total_orders", amount=None, rate=None):
        columns = {"name": (name, "string"), "year": (year, "int"), "quarter": (quarter, "int"),
                   "orders": (orders, "bigint"), "amount": (amount, "double"), "rate": (rate, "double")}
        return published_reports.REPORTS[report](spark, wh).select(F.lit(report).alias("report"), *[
            (F.lit(None) if c is None else F.col(c)).cast(t).alias(n) for n, (c, t) in columns.items()])

    return (lines("table_counts", "tbl", orders="cnt").where("name = 'fact_sales'")
            .unionByName(lines("revenue_by_region", "region_name", amount="total_revenue", rate="avg_profit_margin"))
            .unionByName(lines("revenue_by_category_quarter", "category", "year", "quarter", "orders", "revenue"))
            .unionByName(lines("return_rate_by_payment", "payment_method", amount="returned_orders", rate="return_rate_pct")))


def q_publish_dimensions(spark, sf_dir):
    """dim_customer published from the early orders, then swapped for the full build."""
    wh = Warehouse(scratch_path(spark, "wh"))
    sales = bronze_table(spark, sf_dir)
    early = star_schema(sales.where(F.col("order_date") < FIRST_STEP_BEFORE))
    load_dimension(spark, wh, "dim_customer", early["dim_customer"], "run-1")
    load_dimension(spark, wh, "dim_customer", star_schema(sales)["dim_customer"], "run-2")
    return open_table(spark, wh, "dim_customer")


def q_publish_all(spark, sf_dir):
    """Publish every gold table behind the quality gate, then report Q2 from the published tables."""
    from orderlake.plans.daily_run import quality_gate

    wh = Warehouse(scratch_path(spark, "wh"))
    star = star_schema(bronze_table(spark, sf_dir),
                       key_maps={"dim_region": wh.key_map("dim_region"),
                                 "dim_payment": wh.key_map("dim_payment")})
    load_all(spark, wh, star.tables, "run-1", gate=quality_gate())
    return reports.revenue_by_region(spark.table("fact_sales"), spark.table("dim_region"))


def q_gold_run_metrics(spark, sf_dir):
    """Rows per gold table as observed by the writes themselves (no count jobs)."""
    root = scratch_path(spark, "gold")
    star = _gold(spark, sf_dir, sort_dates=True)
    counts = [(n, write_table(df, f"{root}/{n}")) for n, df in star.tables.items()]
    return spark.createDataFrame(counts, "tbl string, cnt bigint")


def _daily_runs(spark, sf_dir) -> Warehouse:
    """CSV file -> event log -> stream ingest -> gold -> gate -> publish.

    Two daily runs (early orders, then the rest), and the second run repeated:
    the repeat must change nothing.  Each run reads only its new bronze batches.
    """
    root = scratch_path(spark, "daily")
    write_sales_csv(sales_projection(spark, sf_dir), f"{root}/source_csv")
    source = read_sales_csv(spark, f"{root}/source_csv")
    early = F.col("order_date") < FIRST_STEP_BEFORE
    cfg = RunConfig(log=EventLog("files", path=f"{root}/log"), lake_root=f"{root}/lake",
                    warehouse=Warehouse(f"{root}/wh"))
    daily_run(spark, cfg, "run-0001", source=source.where(early))
    daily_run(spark, cfg, "run-0002", source=source.where(~early))
    daily_run(spark, cfg, "run-0002")  # retried run: nothing new is produced or appended
    return cfg.warehouse


def q_end_to_end_run(spark, sf_dir):
    """The daily runs, then Q1 over the published tables."""
    wh = _daily_runs(spark, sf_dir)
    return reports.table_counts({n: open_table(spark, wh, n) for n in GOLD_TABLES})


def q_daily_runs_fact(spark, sf_dir):
    """The published fact after the incremental daily runs equals a one-shot build."""
    return open_table(spark, _daily_runs(spark, sf_dir), "fact_sales")


def q_daily_runs_dim_customer(spark, sf_dir):
    """dim_customer merged run by run (stored latest-state) equals a one-shot build."""
    return open_table(spark, _daily_runs(spark, sf_dir), "dim_customer")


GOLD_QUERIES = {
    "fact_null_fk": q_fact_null_fk,
    "dq_not_empty": _dq("not_empty"),
    "dq_null_keys": _dq("not_null"),
    "dq_duplicate_keys": _dq("unique_key"),
    "dq_orphans": _dq("foreign_key"),
    "dq_domains": _dq("domain"),
    "dq_lengths": _dq("max_length"),
    "dim_incremental_keys": q_dim_incremental_keys,
    "lookup_hot_names": q_lookup_hot_names,
    "fact_replay": q_fact_replay,
    "fact_corrections": q_fact_corrections,
    "fact_changed_replay": q_fact_changed_replay,
    "reports_incremental": q_reports_incremental,
    "publish_dimensions": q_publish_dimensions,
    "publish_all": q_publish_all,
    "gold_run_metrics": q_gold_run_metrics,
    "end_to_end_run": q_end_to_end_run,
    "daily_runs_fact": q_daily_runs_fact,
    "daily_runs_dim_customer": q_daily_runs_dim_customer,
}
