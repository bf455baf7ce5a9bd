"""What one task holds of a keyed join is bounded by rows, not by how Spark coalesces compressed partitions."""
from collections import Counter

from pyspark.sql import functions as F

from cohort.operators import affinity
from cohort.sources import fixtures


def _tables(spark, tmp_path, keys=4000, lines=4):
    o = spark.range(keys).select(F.col("id").alias("o_orderkey"), (F.col("id") % 500).alias("o_custkey"),
                                 F.lit("1-URGENT").alias("o_orderpriority"))
    li = spark.range(keys * lines).select(
        (F.col("id") % keys).alias("l_orderkey"), (F.col("id") % 997).alias("l_partkey"), (F.col("id") % 31).alias("l_suppkey"),
        F.floor(F.col("id") / keys).cast("int").alias("l_linenumber"), F.lit(0.05).alias("l_discount"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"))
    # A null key and a repeated one: the join drops the first and multiplies the second.
    li = li.unionByName(li.limit(1).withColumn("l_orderkey", F.lit(None).cast("bigint")))
    o = o.unionByName(o.where("o_orderkey = 7"))
    o.write.parquet(f"{tmp_path}/orders.parquet")
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_events_of_a_task_are_bounded(spark, tmp_path, monkeypatch):
    d = _tables(spark, tmp_path)
    whole = Counter(map(tuple, fixtures.Fixtures(spark, d).events().collect()))
    monkeypatch.setattr(fixtures, "TASK_ROWS", 200, raising=False)
    fx = fixtures.Fixtures(spark, d)
    cells = affinity.person_cells(fx.events(), fx.devices())
    per_task = cells.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("impressions").alias("n"))
    rows = [r["n"] for r in per_task.collect()]
    assert sum(rows) == 4000 * 4 + 3 * 4  # device 7 twice on both sides
    assert max(rows) <= 2 * 200, max(rows)
    assert Counter(map(tuple, fx.events().collect())) == whole


def test_few_rows_are_left_to_spark(spark, tmp_path):
    d = _tables(spark, tmp_path)
    plan = fixtures.Fixtures(spark, d).events()._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" not in plan
