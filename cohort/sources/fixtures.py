"""Stand-in inputs (``fx_*`` views) derived from the driver's test tables.

The driver ships TPC-H-style tables, not persons/devices/signals, so these
builders only *reshape* those tables into the engine's input schemas
(FIXTURES.md section 2). They do none of the engines' work; every operator
must be correct on any data of these schemas.

Each view exists twice: as a Spark DataFrame builder (used by ``queries()``)
and as SQL text for DuckDB (used by the oracle twins). The texts use the
``BUCKET(salt, expr)`` macro, expanded per dialect by :func:`expand_bucket`.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.functions.expressions import bucket
from cohort.sources.tables import read_table

# Rows of impressions and devices that one task joins, at most (if keys are even).
TASK_ROWS = 1_000_000


def by_key(tables: list[tuple[DataFrame, str]], task_rows: int | None = None) -> list[DataFrame]:
    """The tables dealt out by their keys over enough partitions for ``task_rows`` rows in each, all over equally many.

    What is joined and summed by the same key afterwards stays in these partitions, so the memory of a
    task is bounded by its rows, whatever the input and however many partitions Spark would coalesce
    by their compressed size (a larger ``spark.sql.shuffle.partitions`` may still be used instead). Tables
    are counted from their Parquet footers. If one partition a core is enough, the tables stay as they are.
    """
    n = -(-sum(t.count() for t, _ in tables) // (task_rows or TASK_ROWS))
    if n <= tables[0][0].sparkSession.sparkContext.defaultParallelism:
        return [t for t, _ in tables]
    return [t.repartition(n, key) for t, key in tables]


@dataclass
class Fixtures:
    """Lazily built ``fx_*`` DataFrames over one test-data directory."""

    spark: SparkSession
    prefix: str
    _memo: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = read_table(self.spark, self.prefix, name)
        return self._memo[name]

    # -- persons ---------------------------------------------------------- #
    def persons(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_acctbal")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        j = (c.join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey))
        key = F.col("c_custkey")
        seg = (key * 5) % 8
        conv_cut = F.when(seg.isin(0, 1), F.lit(60)).otherwise(F.lit(15))
        return j.select(
            key.alias("person_id"),
            seg.alias("true_segment"),
            (F.lit(18) + bucket("age", key) % 68).cast("double").alias("age"),
            F.round(F.col("c_acctbal") / 1000.0, 3).alias("income_z"),
            (bucket("rec", key).cast("double") / 10.0).alias("recency_days"),
            F.when(bucket("conv", key) < conv_cut, F.lit(1)).otherwise(F.lit(0)).alias("converted_true"),
            F.when(F.col("r_name") == "EUROPE", "EU")
             .when(F.col("r_name") == "AMERICA", "US").otherwise("OTHER").alias("region"),
            ((F.col("r_name") != "EUROPE") | (bucket("gdpr", key) < 72)).alias("gdpr_consent"),
            ((F.col("r_name") == "AMERICA") & (bucket("ccpa", key) < 12)).alias("ccpa_opt_out"),
        )

    # -- devices ---------------------------------------------------------- #
    def devices(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("device_id"),
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderpriority").alias("device_type"))

    # -- identity signals (one scan of orders, exploded) -------------------- #
    def signals(self) -> DataFrame:
        o = F.col("o_orderkey")
        cust = F.col("o_custkey")
        b_ip = bucket("ip", o)

        def sig(t: str, v):
            return F.struct(F.lit(t).alias("signal_type"), v.alias("signal_value"))

        ip_val = (F.when(b_ip < 80, F.concat(F.lit("hh_"), F.floor(cust / 2).cast("bigint").cast("string")))
                   .when(b_ip < 90, F.concat(F.lit("pub_"), (cust % 7).cast("string")))
                   .otherwise(F.concat(F.lit("tr_"), o.cast("string"))))
        arr = F.array(
            sig("cookie", F.concat(F.lit("ck_"), o.cast("string"))),
            F.when(bucket("em", o) < 50, sig("hashed_email", F.concat(F.lit("em_"), cust.cast("string")))),
            F.when(F.col("o_orderpriority") != "5-LOW", sig("maid", F.concat(F.lit("ma_"), o.cast("string")))),
            sig("ip", ip_val),
        )
        return (self.raw("orders")
                .select(o.alias("device_id"), F.explode(arr).alias("s"))
                .where(F.col("s").isNotNull())
                .select("device_id", "s.signal_type", "s.signal_value"))

    # -- impression events -------------------------------------------------- #
    def events(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                         "l_discount", "l_returnflag")
        od = self.raw("orders").select("o_orderkey", "o_custkey")
        li, od = by_key([(li, "l_orderkey"), (od, "o_orderkey")])
        j = li.join(od, li.l_orderkey == od.o_orderkey)
        home = ((F.col("o_custkey") * 5) % 8 + F.col("l_suppkey") % 2) % 12
        cat = F.when(F.col("l_partkey") % 10 < 7, home).otherwise(F.col("l_partkey") % 12)
        return j.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("event_id"),
            F.col("l_orderkey").alias("device_id"),
            F.concat(F.lit("cat_"), F.lpad(cat.cast("string"), 2, "0")).alias("content_cat"),
            F.concat(F.lit("cmp_"), (F.col("l_suppkey") % 6).cast("string")).alias("campaign"),
            (F.col("l_linenumber") % 4).cast("int").alias("creative"),
            (F.col("l_linenumber") % 5).cast("int").alias("position"),
            F.round(F.col("l_discount") * 10, 3).alias("bid"),
            F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("click"),
        )

    # -- campaign reward stream ------------------------------------------- #
    def campaign_stream(self) -> DataFrame:
        return campaign_stream_from(self.raw("events")).drop("ts")

    def campaign_truth(self) -> DataFrame:
        """``[creative, true_rate]``: the rate by which :func:`campaign_stream_from` draws each arm's rewards."""
        arms = self.raw("events").select((F.col("user_id") % 6).alias("arm")).distinct()
        return arms.select(F.concat(F.lit("cr_"), F.col("arm").cast("string")).alias("creative"),
                           (reward_percent(F.col("arm")) / 100).alias("true_rate"))


def reward_percent(arm):
    return F.lit(3) + arm + F.when(arm == 4, F.lit(4)).otherwise(F.lit(0))


def campaign_stream_from(events: DataFrame) -> DataFrame:
    """Reshape driver ``events`` rows (batch or streaming) into reward-stream rows."""
    ev = events.select("event_id", "ts", "user_id")
    arm = F.col("user_id") % 6
    cut = reward_percent(arm)
    return ev.select(
        F.col("event_id").alias("round"),
        F.col("ts").alias("ts"),
        F.col("ts").cast("date").alias("batch"),
        F.concat(F.lit("cr_"), arm.cast("string")).alias("creative"),
        F.when(bucket("rw", F.col("event_id")) < cut, F.lit(1)).otherwise(F.lit(0)).alias("reward"),
    )


# --------------------------------------------------------------------------- #
# SQL text of the same views (DuckDB dialect after BUCKET expansion).

FX_SQL: dict[str, str] = {
    "fx_persons": """
select c_custkey as person_id,
       (c_custkey * 5) % 8 as true_segment,
       cast(18 + BUCKET('age', c_custkey) % 68 as double) as age,
       round(c_acctbal / 1000.0, 3) as income_z,
       cast(BUCKET('rec', c_custkey) as double) / 10.0 as recency_days,
       case when BUCKET('conv', c_custkey) < case when (c_custkey * 5) % 8 in (0, 1) then 60 else 15 end
            then 1 else 0 end as converted_true,
       case r_name when 'EUROPE' then 'EU' when 'AMERICA' then 'US' else 'OTHER' end as region,
       (r_name <> 'EUROPE' or BUCKET('gdpr', c_custkey) < 72) as gdpr_consent,
       (r_name = 'AMERICA' and BUCKET('ccpa', c_custkey) < 12) as ccpa_opt_out
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fx_devices": """
select o_orderkey as device_id, o_custkey as person_id, o_orderpriority as device_type from orders""",
    "fx_signals": """
select o_orderkey as device_id, 'cookie' as signal_type, concat('ck_', cast(o_orderkey as string)) as signal_value from orders
union all
select o_orderkey, 'hashed_email', concat('em_', cast(o_custkey as string)) from orders where BUCKET('em', o_orderkey) < 50
union all
select o_orderkey, 'maid', concat('ma_', cast(o_orderkey as string)) from orders where o_orderpriority <> '5-LOW'
union all
select o_orderkey, 'ip',
       case when BUCKET('ip', o_orderkey) < 80 then concat('hh_', cast(cast(floor(o_custkey / 2) as bigint) as string))
            when BUCKET('ip', o_orderkey) < 90 then concat('pub_', cast(o_custkey % 7 as string))
            else concat('tr_', cast(o_orderkey as string)) end
from orders""",
    "fx_events": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as event_id,
       l_orderkey as device_id,
       concat('cat_', lpad(cast(case when l_partkey % 10 < 7 then ((o_custkey * 5) % 8 + l_suppkey % 2) % 12
                                     else l_partkey % 12 end as string), 2, '0')) as content_cat,
       concat('cmp_', cast(l_suppkey % 6 as string)) as campaign,
       cast(l_linenumber % 4 as int) as creative,
       cast(l_linenumber % 5 as int) as position,
       round(l_discount * 10, 3) as bid,
       case when l_returnflag = 'R' then 1 else 0 end as click
from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_campaign_stream": """
select event_id as round, cast(ts as date) as batch,
       concat('cr_', cast(user_id % 6 as string)) as creative,
       case when BUCKET('rw', event_id) < 3 + user_id % 6 + case when user_id % 6 = 4 then 4 else 0 end then 1 else 0 end as reward
from events""",
}

_BUCKET = re.compile(r"BUCKET\('([a-z]+)',\s*([a-z_]+)\)")


def expand_bucket(sql: str, dialect: str = "duckdb") -> str:
    def one(m: re.Match) -> str:
        key = f"concat('{m.group(1)}|', cast({m.group(2)} as string))"
        if dialect == "duckdb":
            return f"(('0x'||substr(md5({key}),1,8))::BIGINT % 100)"
        return f"(cast(conv(substr(md5({key}),1,8),16,10) as bigint) % 100)"
    return _BUCKET.sub(one, sql)


def fx_cte(names: list[str], dialect: str = "duckdb") -> str:
    """``name AS (...)`` fragments for a WITH clause."""
    return ",\n".join(f"{n} AS ({expand_bucket(FX_SQL[n], dialect)})" for n in names)
