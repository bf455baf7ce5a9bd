"""Skewed keys, streaming posteriors and the batch job wrapper."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohort import job
from cohort.operators import blocking, campaign
from cohort.operators import graph as graph_mod
from cohort.operators.graph import connected_components
from cohort.streaming import arm_posteriors
from conftest import SF001


def test_hot_block_is_dropped_not_paired(spark):
    # One IP value carries a third of all rows: it must be dropped before pairing.
    hot = [(i, "ip", "hot") for i in range(300)]
    small = [(1000 + i, "ip", f"hh{i // 2}") for i in range(600)]
    s = spark.createDataFrame(hot + small, "device_id long, signal_type string, signal_value string")
    pairs = blocking.ip_candidates(s)
    assert pairs.count() == 300
    assert pairs.where(F.col("src") < 1000).count() == 0


def test_hub_node_star_graph(spark):
    n = 500
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
    edges = spark.createDataFrame([(250, i) for i in range(n) if i != 250], "src long, dst long")
    comp = connected_components(nodes, edges).agg(F.countDistinct("component").alias("c"),
                                                 F.max("component").alias("m")).first()
    assert (comp.c, comp.m) == (1, 0)


def test_windowed_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="stream-in-", dir="/tmp")
    rows = [("t", "a", 1, "2024-01-01 00:10:00"), ("t", "a", 0, "2024-01-01 00:20:00"),
            ("t", "b", 1, "2024-01-01 01:10:00"), ("t", "a", 1, "2024-01-01 01:15:00")]
    df = spark.createDataFrame(rows, "test string, arm string, reward int, ts string") \
              .withColumn("ts", F.to_timestamp("ts"))
    df.write.mode("overwrite").parquet(os.path.join(d, "rewards"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(d, "rewards"))
    out, ckpt = arm_posteriors.scratch_paths(spark, "test-windowed")
    post = arm_posteriors.posterior_stream(stream, ts="ts", window="1 hour", watermark="2 hours")
    arm_posteriors.run_available(post, out, ckpt, windowed=True)
    got = arm_posteriors.latest(spark.read.parquet(out), ["window", "test", "arm"])
    want = campaign.beta_posterior(campaign.arm_counts(
        df.withColumn("window", F.window("ts", "1 hour")), ["window", "test"]))
    key = lambda r: (str(r["window"]), r["arm"])
    assert sorted((key(r), r.successes, r.failures) for r in got.collect()) == \
        sorted((key(r), r.successes, r.failures) for r in want.collect())


def test_campaign_job_writes_tables_and_metrics(spark):
    out = tempfile.mkdtemp(prefix="job-", dir="/tmp")
    args = type("A", (), {"fixtures": SF001, "data": None})()
    job.run(spark, "campaign", job._inputs(spark, args), out)
    assert spark.read.parquet(f"{out}/posteriors").count() == 6
    m = {r.metric: r.value for r in spark.read.json(f"{out}/metrics").collect()}
    assert m["p_best"] > 0.5


def _most_in_a_task(df):
    """(rows, rows of the fullest partition) of a plan's last step before any further exchange."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return sum(n), max(n)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hub_edges_stay_spread_with_and_without_aqe(spark, adaptive):
    """Half of all edges at one node: no task of the look-up joins gets them, with AQE or without."""
    from cohort.session import materialize
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive,
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # small tables would become one task
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        star = spark.range(20000).where("id != 7").select(F.lit(7).cast("long").alias("src"), F.col("id").alias("dst"))
        path = spark.range(20000).select((F.col("id") + 20000).alias("src"), (F.col("id") - F.col("id") % 4 + 20000).alias("dst"))
        edges = star.unionByName(path).repartition(8)
        e = materialize(graph_mod.canonical_edges(spark.range(40000).select("id"), edges))
        stats = materialize(graph_mod._node_stats(e))
        limit = graph_mod.hub_limit(e.count())
        up = graph_mod.symmetrize(e, "hi", "lo").where("v > u")
        mu = stats.select("u", F.least("u", "m").alias("mu"), (F.col("n_lt") + F.col("n_gt")).alias("degree"))
        total, most = _most_in_a_task(graph_mod.at_nodes(up, "u", mu, limit))
        assert total == up.count() and most < 0.25 * total
        assert stats.where(F.col("n_lt") + F.col("n_gt") >= limit).count() <= 2 * graph_mod.HUB_SHARE
        comp = graph_mod.connected_components(spark.range(40000).select("id"), edges)
        assert comp.where("component != if(id < 20000, 0, id - id % 4)").count() == 0 and comp.count() == 40000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_look_up_at_nodes_equals_a_join(spark):
    rows = spark.createDataFrame([(i % 3 if i % 2 else i, i) for i in range(400)], "k long, v long")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("degree"), F.max("v").alias("m")).where("k != 4")
    want = sorted(map(tuple, rows.join(table.drop("degree"), "k").collect()))
    for limit in (1, 2, 50, 1000):
        assert sorted(map(tuple, graph_mod.at_nodes(rows, "k", table, limit).collect())) == want


def _hot_ip(spark, n=30000):
    return spark.range(n).select(F.col("id").alias("device_id"), F.lit("ip").alias("signal_type"),
                                 F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                  .otherwise(F.concat(F.lit("h"), (F.col("id") / 2).cast("long").cast("string")))
                                  .alias("signal_value"))


def test_blocking_salts_a_hot_value(spark):
    """A value holding a third of all rows meets its removal in many partitions, whatever the skew settings."""
    members = blocking._members(_hot_ip(spark), ["ip"], False)
    spread = members.withColumn("salt", F.pmod(F.xxhash64("device_id"), F.lit(blocking.SALTS)).cast("int"))
    parts = (spread.repartition(64, "block_type", "signal_value", "salt").groupBy(F.spark_partition_id()).count()
                   .agg(F.max("count").alias("most"), F.sum("count").alias("all")).first())
    assert parts["most"] < 0.1 * parts["all"]
    plan = blocking.ip_candidates(_hot_ip(spark))._jdf.queryExecution().sparkPlan().toString()
    assert "LeftAnti" in plan and "salt" in plan
    assert blocking.ip_candidates(_hot_ip(spark)).where(F.col("src") % 3 == 0).where(F.col("dst") % 3 == 0).count() == 0


def test_star_edges_split_a_hot_value_under_default_skew_settings(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stars = blocking.star_edges(_hot_ip(spark), ["ip"])
        plan = stars._jdf.queryExecution().executedPlan()
        plan.execute().count()
        assert "skew=true" in plan.toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_large_deterministic_block_is_one_component(spark):
    """300 devices on one e-mail link without a cap; the pair report names the block."""
    from cohort.operators.graph import connected_components
    s = spark.range(300).select(F.col("id").alias("device_id"), F.lit("hashed_email").alias("signal_type"),
                                F.lit("shared").alias("signal_value"))
    nodes = s.select(F.col("device_id").alias("id"))
    assert blocking.star_edges(s).count() == 299
    assert connected_components(nodes, blocking.star_edges(s)).select("component").distinct().count() == 1
    r = blocking.suppressed_blocks(s).first()
    assert (r.n_devices, r.pairs_not_formed) == (300, 300 * 299 // 2)


def test_stream_restart_picks_up_only_new_files(spark):
    d = tempfile.mkdtemp(prefix="stream-restart-", dir="/tmp")
    schema = "test string, arm string, reward int"
    spark.createDataFrame([("t", "a", 1), ("t", "a", 0)], schema).write.parquet(os.path.join(d, "part1"))
    out, ckpt = arm_posteriors.scratch_paths(spark, "test-restart")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(d)
        arm_posteriors.run_available(arm_posteriors.posterior_stream(stream), out, ckpt)
        return {r.arm: (r.successes, r.failures) for r in spark.read.parquet(out).collect()}

    assert run() == {"a": (1, 1)}
    spark.createDataFrame([("t", "a", 1), ("t", "b", 0)], schema).write.parquet(os.path.join(d, "part2"))
    assert run() == {"a": (2, 1), "b": (0, 1)}


def test_streaming_reads_a_folder_table_and_refuses_an_empty_one(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="stream-folder-", dir="/tmp")
    df = spark.createDataFrame([("t", "a", 1), ("t", "a", 0), ("t", "b", 1)], "test string, arm string, reward int")
    df.repartition(3).write.parquet(os.path.join(d, "events.parquet"))
    stream = arm_posteriors.read_stream_table(spark, d, "events", df.schema)
    out, ckpt = arm_posteriors.scratch_paths(spark, "test-folder")
    arm_posteriors.run_available(arm_posteriors.posterior_stream(stream), out, ckpt)
    got = sorted((r.arm, r.successes, r.failures) for r in spark.read.parquet(out).collect())
    assert got == sorted((r.arm, r.successes, r.failures) for r in campaign.arm_counts(df).collect())
    df.limit(0).write.parquet(os.path.join(d, "none.parquet"))
    with pytest.raises(ValueError):
        arm_posteriors.read_stream_table(spark, d, "none", df.schema)


def _tables_with_string_ids(spark, d):
    """Small tables of the logical schemas, with string ids and the optional columns as a user may have them."""
    from cohort.sources.fixtures import Fixtures
    fx = Fixtures(spark, SF001)
    text = lambda df, *cols: df.withColumns({c: F.concat(F.lit("x"), F.col(c).cast("string")) for c in cols})
    tables = {
        "persons": fx.persons().withColumn("processing_allowed", F.col("gdpr_consent") & ~F.col("ccpa_opt_out")),
        "devices": text(fx.devices(), "device_id"), "identity_signals": text(fx.signals(), "device_id"),
        "events": text(fx.events(), "device_id").withColumn("convert", F.lit(0)),
        "campaign_stream": fx.campaign_stream().drop("batch")}
    for name, df in tables.items():
        df.write.parquet(os.path.join(d, f"{name}.parquet"))


def test_job_reads_tables_with_string_ids(spark):
    import pytest

    from cohort.sources.tables import conform
    d, out = tempfile.mkdtemp(prefix="tables-", dir="/tmp"), tempfile.mkdtemp(prefix="job-", dir="/tmp")
    _tables_with_string_ids(spark, d)
    t = job._inputs(spark, type("A", (), {"fixtures": None, "data": d})())
    assert dict(t["devices"].dtypes)["device_id"] == "string" and "processing_allowed" in t["persons"].columns
    for module in ("identity", "ctr", "lookalike", "campaign"):
        job.run(spark, module, t, f"{out}/{module}")
        assert spark.read.json(f"{out}/{module}/metrics").count() > 0
    ids = spark.read.parquet(f"{out}/identity/resolved_ids")
    assert dict(ids.dtypes)["id"] == "string" and ids.count() > 0
    assert spark.read.parquet(f"{out}/campaign/replay").select("batch").distinct().count() > 1
    with pytest.raises(ValueError, match="missing column"):
        conform(t["devices"].drop("person_id"), "devices")

