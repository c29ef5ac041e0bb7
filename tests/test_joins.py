"""J1/J2 beyond the broadcast bound."""

from statistics import median

from pyspark.sql import functions as F

from orderlake.operators.joins import lookup_key


def _orders(spark, n=20_000):
    """Three tenths of the rows have one name, a fifth an unknown one, a tenth none; the others are spread."""
    k = F.col("id") % 10
    name = (F.when(k < 3, F.lit("hot")).when(k < 5, F.lit("unknown")).when(k < 6, F.lit(None))
            .otherwise(F.concat(F.lit("n"), (F.col("id") % 997).cast("string"))))
    return spark.range(n).repartition(4, "id").select("id", name.alias("name"))


def _dim(spark):
    return spark.createDataFrame([("hot", 0), *[(f"n{i}", i + 1) for i in range(900)]], "who string, who_id long")


def test_same_rows_as_the_broadcast_lookup(spark):
    orders, dim = _orders(spark), _dim(spark)
    small = lookup_key(orders, dim, "name", "who", "who_id")
    large = lookup_key(orders, dim, "name", "who", "who_id", max_rows=0)
    assert large.columns == small.columns == ["id", "name", "who_id"]
    assert large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()
    got = {r.name: r.n for r in large.groupBy("name").agg(F.countDistinct("who_id").alias("n")).collect()}
    assert got["hot"] == 1 and got["unknown"] == 0 and got[None] == 0


def test_the_same_column_name_on_both_sides_and_no_rows(spark):
    orders, dim = _orders(spark, 100), _dim(spark).withColumnRenamed("who", "name")
    out = lookup_key(orders, dim, "name", "name", "who_id", known_rows=901, max_rows=900)
    assert out.columns == ["id", "name", "who_id"] and out.count() == 100
    assert lookup_key(orders.limit(0), dim, "name", "name", "who_id", max_rows=0).count() == 0
    assert lookup_key(orders, dim.limit(0), "name", "name", "who_id", known_rows=901, max_rows=0).count() == 100


def test_no_task_gets_the_hot_names(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "-1")):
            spark.conf.set(k, v)
        large = lookup_key(_orders(spark), _dim(spark), "name", "who", "who_id", max_rows=0)
        sizes = [r["count"] for r in large.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * median(sizes)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
