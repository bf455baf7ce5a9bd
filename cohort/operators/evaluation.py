"""Evaluation operators as Spark aggregations.

Nothing here collects rows to the driver. Pair counts use the identity
``#pairs = sum_g C(n_g, 2)`` over group sizes, so no pair is ever
materialised; rank-based metrics first collapse rows to one row per distinct
score, then take running sums (see :func:`ordered_prefix_sums`).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort.functions.expressions import binary_entropy, choose2
from cohort.session import materialize

from cohort.constants import FALLBACK_THRESHOLD, PRECISION_TARGET  # noqa: F401

LOGLOSS_CLIP = 1e-15


# --------------------------------------------------------------------------- #
# Pair-counting agreement between two labellings.

def _contingency(assign: DataFrame, truth: DataFrame, key: str, a: str, b: str) -> DataFrame:
    return assign.select(key, a).join(truth.select(key, b), key).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def pair_agreement(assign: DataFrame, truth: DataFrame, key: str = "id",
                   a: str = "component", b: str = "person") -> DataFrame:
    """One row ``[n, s_both, s_a, s_b]`` of pair counts.

    ``s_both`` = pairs together in both labellings, ``s_a`` / ``s_b`` = pairs
    together in ``a`` / ``b``; all over rows present in both inputs.
    The contingency table has one row per non-empty (a, b) cell, so a giant
    cluster adds one row, not n^2 pairs.
    """
    cells = _contingency(assign, truth, key, a, b)
    rows_a = cells.groupBy(a).agg(F.sum("n").alias("n"))
    rows_b = cells.groupBy(b).agg(F.sum("n").alias("n"))
    stacked = (cells.select(F.lit(0).alias("k"), "n")
               .unionByName(rows_a.select(F.lit(1).alias("k"), "n"))
               .unionByName(rows_b.select(F.lit(2).alias("k"), "n")))
    return stacked.agg(
        F.coalesce(F.sum(F.when(F.col("k") == 0, F.col("n"))), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum(F.when(F.col("k") == 0, choose2("n"))), F.lit(0)).cast("bigint").alias("s_both"),
        F.coalesce(F.sum(F.when(F.col("k") == 1, choose2("n"))), F.lit(0)).cast("bigint").alias("s_a"),
        F.coalesce(F.sum(F.when(F.col("k") == 2, choose2("n"))), F.lit(0)).cast("bigint").alias("s_b"))


def pairwise_prf(assign: DataFrame, truth: DataFrame, key: str = "id",
                 a: str = "component", b: str = "person", digits: int = 6) -> DataFrame:
    """Pairwise precision / recall / F1 of a clustering vs. truth.

    tp = pairs co-clustered in both; predicted = co-clustered pairs among the
    evaluated ids; true = co-person pairs over the whole truth table. Each
    ratio is 0 when its denominator is 0 (an all-singleton clustering gives
    precision 0, not a division error).
    """
    agree = pair_agreement(assign, truth, key, a, b).select(
        F.col("s_both").alias("tp"), F.col("s_a").alias("predicted_pairs"))
    real = (truth.groupBy(b).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.coalesce(F.sum(choose2("n")), F.lit(0)).cast("bigint").alias("true_pairs")))
    # Both sides are single-row aggregates; union + max stitches them without a join.
    both = (agree.select("tp", "predicted_pairs", F.lit(None).cast("bigint").alias("true_pairs"))
            .unionByName(real.select(F.lit(None).cast("bigint").alias("tp"),
                                     F.lit(None).cast("bigint").alias("predicted_pairs"), "true_pairs"))
            .agg(F.max("tp").alias("tp"), F.max("predicted_pairs").alias("predicted_pairs"),
                 F.max("true_pairs").alias("true_pairs")))
    p = F.when(F.col("predicted_pairs") > 0, F.col("tp") / F.col("predicted_pairs")).otherwise(F.lit(0.0))
    r = F.when(F.col("true_pairs") > 0, F.col("tp") / F.col("true_pairs")).otherwise(F.lit(0.0))
    out = both.select("tp", "predicted_pairs", "true_pairs", p.alias("precision"), r.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return out.select("tp", "predicted_pairs", "true_pairs",
                      F.round("precision", digits).alias("precision"),
                      F.round("recall", digits).alias("recall"),
                      F.round(f1, digits).alias("f1"))


def adjusted_rand(assign: DataFrame, truth: DataFrame, key: str, a: str, b: str,
                  digits: int = 6) -> DataFrame:
    """Adjusted Rand index (Hubert & Arabie 1985) from a contingency aggregate (M7).

    ARI = (S - E) / ((A + B)/2 - E), E = A*B / C(n, 2); 1.0 when the
    denominator is 0 (both labellings trivial).
    """
    g = pair_agreement(assign, truth, key, a, b)
    s, sa, sb = (F.col(c).cast("double") for c in ("s_both", "s_a", "s_b"))
    pairs = (F.col("n").cast("double") * (F.col("n") - 1) / 2)
    e = F.when(pairs > 0, sa * sb / pairs).otherwise(F.lit(0.0))
    den = (sa + sb) / 2 - e
    ari = F.when(den == 0, F.lit(1.0)).otherwise((s - e) / den)
    return g.select(F.col("n").alias("n"), F.round(ari, digits).alias("ari"))


# --------------------------------------------------------------------------- #
# Rank-based metrics on (score, label).

def score_groups(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score: ``[score, pos, neg]`` (ties decided together); rows without a score do not count."""
    return scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"))


def _ranges(spark) -> int:
    """Ranges for ordered operators: as many as the session shuffles into, which is set by data size."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordered_prefix_sums(groups: DataFrame, order_col: str, value_cols: list[str],
                        descending: bool = True) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_col``.

    Scales past one task: rows are range-partitioned on ``order_col``, each
    range is totalled (one tiny row per range), the per-range offsets are
    computed from those totals, and the running sum inside a range is a
    window *partitioned by range id*. No window runs over the whole table.
    """
    sign = -1 if descending else 1
    key = F.col(order_col) * F.lit(sign)
    g = groups.withColumn("_k", key)
    n_parts = _ranges(g.sparkSession)
    # Range bounds come from a sample, so two scans of an unpinned range
    # exchange can disagree; the assignment is checkpointed once and both
    # consumers (range totals and in-range sums) read the same rows.
    g = materialize(g.repartitionByRange(n_parts, "_k").withColumn("_part", F.spark_partition_id()))
    # Range ids follow key order, so offsets are running sums over range totals.
    totals = g.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w_off = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}")
                                       for c in value_cols])
    w_in = Window.partitionBy("_part").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    # ``offsets`` has one row per range: a bounded broadcast.
    out = g.join(F.broadcast(offsets), "_part")
    for c in value_cols:
        out = out.withColumn(f"cum_{c}", F.sum(c).over(w_in) + F.col(f"_o_{c}"))
    return out.drop("_k", "_part", *[f"_o_{c}" for c in value_cols])


def precision_threshold(scored: DataFrame, target: float = PRECISION_TARGET, score: str = "score",
                        label: str = "label") -> DataFrame:
    """Lowest score whose cumulative precision (score descending) reaches target.

    A tie group is admitted or rejected as a whole. Falls back to 0.5 when
    no score reaches the target. Output: ``[threshold, kept_pos, kept_neg, precision]``.
    """
    return precision_threshold_of(score_groups(scored, score, label), target)


def precision_threshold_of(groups: DataFrame, target: float = PRECISION_TARGET) -> DataFrame:
    """:func:`precision_threshold` from :func:`score_groups`."""
    cum = ordered_prefix_sums(groups, "score", ["pos", "neg"])
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    ok = cum.where(prec >= target).select("score", "cum_pos", "cum_neg", prec.alias("precision"))
    best = ok.agg(F.min_by(F.struct("score", "cum_pos", "cum_neg", "precision"), F.col("score")).alias("b"))
    return best.select(
        F.coalesce(F.col("b.score"), F.lit(FALLBACK_THRESHOLD)).alias("threshold"),
        F.coalesce(F.col("b.cum_pos"), F.lit(0)).alias("kept_pos"),
        F.coalesce(F.col("b.cum_neg"), F.lit(0)).alias("kept_neg"),
        F.col("b.precision").alias("precision"))


def auc(scored: DataFrame, score: str = "score", label: str = "label", digits: int = 6) -> DataFrame:
    """Exact area under ROC by rank-sum with ties counted half.

    AUC = sum_s pos_s * (neg below s + neg_s / 2) / (P * N); NULL if P or N is 0.
    """
    return auc_of(score_groups(scored, score, label), digits)


def auc_of(groups: DataFrame, digits: int = 6) -> DataFrame:
    """:func:`auc` from :func:`score_groups`."""
    cum = ordered_prefix_sums(groups, "score", ["neg"], descending=False)
    # cum_neg includes the group itself; "below" excludes it.
    contrib = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)
    t = cum.agg(F.sum(contrib).alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    val = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P").cast("double") * F.col("N")))
    return t.select(F.col("P").cast("bigint").alias("positives"), F.col("N").cast("bigint").alias("negatives"),
                    F.round(val, digits).alias("auc"))


def log_loss(scored: DataFrame, prob: str = "prob", label: str = "label", digits: int = 6) -> DataFrame:
    """Mean negative log-likelihood with p clipped to [1e-15, 1-1e-15]."""
    p = F.least(F.greatest(F.col(prob), F.lit(LOGLOSS_CLIP)), F.lit(1 - LOGLOSS_CLIP))
    y = F.col(label).cast("double")
    ll = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(ll), digits).alias("log_loss"))


def base_rate_baseline(train: DataFrame, label: str = "label", digits: int = 6) -> DataFrame:
    """Constant-predictor baseline (M20): base rate and its log loss (label entropy).

    A base rate of 0 or 1 gives a baseline of 0 rather than ``log(0)``.
    """
    return (train.agg(F.avg(F.col(label).cast("double")).alias("base_rate"), F.count(F.lit(1)).alias("n"))
                 .select("n", F.round("base_rate", digits).alias("base_rate"),
                         F.round(binary_entropy("base_rate"), digits).alias("baseline_log_loss")))


def relative_reduction(model_value, baseline_value):
    """(baseline - model) / baseline, NULL when the baseline is 0."""
    return F.try_divide(baseline_value - model_value, baseline_value)


# --------------------------------------------------------------------------- #
# Ranking.

def top_fraction(scored: DataFrame, fraction: float, score: str = "score", key: str = "id") -> DataFrame:
    """Rows ranked in the top ``max(1, int(fraction * n))`` by score desc, id asc.

    Output adds ``rank`` (1-based, unique). See :func:`global_rank`.
    """
    ranked = global_rank(scored, score, key)
    k = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(fraction)).cast("bigint"))
    return ranked.where(F.col("rank") <= k).drop("_n")


def global_rank(df: DataFrame, score: str, key: str) -> DataFrame:
    """Dense 1-based position in (score desc, key asc) order, plus the total ``_n``; null scores come last.

    Scales past one task and shuffles once: rows are range-partitioned on the
    composite sort key (so even one score shared by a third of the rows is
    split across ranges by ``key``) and sorted inside their range, where
    ``monotonically_increasing_id`` holds the range in its upper bits and
    the position in its lower 33. Both are checkpointed, so ranges and
    positions stay fixed; a rank is the position plus the rows of the ranges before.
    """
    order = [F.col(score).desc_nulls_last(), F.col(key).asc()]
    g = materialize(df.repartitionByRange(_ranges(df.sparkSession), *order).sortWithinPartitions(*order)
                      .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    totals = g.select(part).groupBy("_part").agg(F.count(F.lit(1)).alias("_t"))
    w_off = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_t").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_t").over(Window.partitionBy()).alias("_n"))
    # One row per range: a bounded broadcast.
    return (g.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
             .withColumn("rank", F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_off") + 1)
             .drop("_at", "_part", "_off"))


def top_n_per_group(df: DataFrame, group: str, value: str, tiebreak: str, n: int = 2) -> DataFrame:
    """Top ``n`` rows per group by value desc, tiebreak asc."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(tiebreak).asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def rate_lift(df: DataFrame, target: str, selected: str, digits: int = 6) -> DataFrame:
    """Base rate, selected rate and lift (L8); lift NULL when the base rate is 0."""
    t = F.col(target).cast("double")
    agg = df.agg(F.count(F.lit(1)).alias("pool"),
                 F.count_if(F.col(selected)).alias("selected"),
                 F.avg(t).alias("base_rate"),
                 F.avg(F.when(F.col(selected), t)).alias("selected_rate"))
    return agg.select("pool", "selected", F.round("base_rate", digits).alias("base_rate"),
                      F.round("selected_rate", digits).alias("selected_rate"),
                      F.round(F.try_divide(F.col("selected_rate"), F.when(F.col("base_rate") != 0,
                                                                          F.col("base_rate"))), digits)
                       .alias("lift"))
