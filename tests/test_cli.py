"""The spark-submit entry point: declare, one daily run, a report."""

import pytest

from orderlake import cli
from orderlake.config import scratch_path
from orderlake.plans.publish import Warehouse, open_table
from orderlake.sources.csv import write_sales_csv
from orderlake.sources.faults import damage_csv
from orderlake.sources.tables import sales_projection
from tests.conftest import SF_SMALL


def test_declare_run_report(spark, capsys):
    root = scratch_path(spark, "cli")
    write_sales_csv(sales_projection(spark, SF_SMALL), f"{root}/csv")
    cli.main(["declare", "--database", "orderlake_cli", "--warehouse", f"{root}/wh"])
    args = ["run", "--run-id", "r1", "--log", f"{root}/log", "--lake", f"{root}/lake",
            "--warehouse", f"{root}/wh", "--database", "orderlake_cli", "--source-csv", f"{root}/csv"]
    cli.main(args)
    cli.main(args)  # a retried run changes nothing
    out = capsys.readouterr().out
    assert '"fact_sales": 5999' in out and '"sent": 6000' in out
    assert spark.table("orderlake_cli.dim_customer").count() == 150  # declared table re-pointed
    cli.main(["report", "return_rate_by_payment", "--warehouse", f"{root}/wh"])
    assert "1-URGENT" in capsys.readouterr().out
    spark.catalog.setCurrentDatabase("default")


def test_damaged_lines_and_capped_runs(spark, capsys):
    """A mistyped field goes to quarantine, not to gold as NULL; runs under a cap catch up one after the other."""
    root = scratch_path(spark, "cli-capped")
    write_sales_csv(damage_csv(sales_projection(spark, SF_SMALL)), f"{root}/csv")
    args = ["--log", f"{root}/log", "--lake", f"{root}/lake", "--warehouse", f"{root}/wh"]
    cli.main(["run", "--run-id", "r0", *args, "--source-csv", f"{root}/csv", "--max-records", "4000"])
    cli.main(["run", "--run-id", "r0", *args, "--source-csv", f"{root}/csv", "--max-records", "4000"])
    bronze, bad = (spark.read.parquet(f"{root}/lake/{t}") for t in ("bronze", "quarantine"))
    assert bronze.count() + bad.count() == 4000
    cli.main(["run", "--run-id", "r1", *args, "--max-records", "4000"])
    bronze, bad = (spark.read.parquet(f"{root}/lake/{t}") for t in ("bronze", "quarantine"))
    assert bronze.count() + bad.count() == 6000
    assert bronze.where("quantity is null or price is null").isEmpty()
    line = bad.where("reject_reason = 'damaged csv line'").first()
    assert bad.where("reject_reason <> 'damaged csv line'").isEmpty()
    assert line.raw_value.startswith(f"{line.order_id},") and not line.raw_value.startswith("csv:")
    published = open_table(spark, Warehouse(f"{root}/wh"), "fact_sales")
    assert published.count() == bronze.select("order_id").distinct().count()
    with pytest.raises(ValueError, match="keep to it"):
        cli.main(["run", "--run-id", "r2", *args])
