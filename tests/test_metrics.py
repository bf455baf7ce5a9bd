import math

import pytest

from pyspark.sql import functions as F

from cohort.operators import campaign, evaluation, lookalike
from cohort.operators.affinity import device_profiles, pair_features


def _scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label double")


def test_device_without_events_has_cosine_zero(spark):
    devices = spark.createDataFrame([(1, 10, "a"), (2, 10, "a"), (3, 11, "b")],
                                    "device_id long, person_id long, device_type string")
    events = spark.createDataFrame([(1, "cat_00", 0), (2, "cat_00", 1)], "device_id long, content_cat string, click int")
    cands = spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long")
    got = {(r.src, r.dst): (r.cosine, r.same_type, r.label)
           for r in pair_features(cands, device_profiles(devices, events), 1).collect()}
    assert got[(1, 2)] == (pytest.approx(1.0), 1.0, 1.0)
    assert got[(1, 3)] == (0.0, 0.0, 0.0)


def test_threshold_tie_group_decided_together(spark):
    # At score 0.8 the group {pos, neg} gives cumulative precision 2/3; at 0.9 it is 1.
    rows = [(0.9, 1.0), (0.8, 1.0), (0.8, 0.0), (0.1, 0.0)]
    r = evaluation.precision_threshold(_scored(spark, rows), 0.9).first()
    assert (r.threshold, r.kept_pos, r.kept_neg) == (0.9, 1, 0)


def test_threshold_falls_back_to_half(spark):
    r = evaluation.precision_threshold(_scored(spark, [(0.9, 0.0), (0.2, 1.0)]), 0.9).first()
    assert r.threshold == 0.5 and r.kept_pos == 0


def test_auc_matches_brute_force_with_ties(spark):
    rows = [(0.1, 0.0), (0.4, 1.0), (0.4, 0.0), (0.35, 1.0), (0.8, 1.0), (0.2, 0.0), (0.8, 0.0)]
    pos = [s for s, l in rows if l == 1]
    neg = [s for s, l in rows if l == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluation.auc(_scored(spark, rows)).first().auc == pytest.approx(brute, abs=1e-6)


def test_auc_null_without_both_classes(spark):
    assert evaluation.auc(_scored(spark, [(0.1, 1.0), (0.3, 1.0)])).first().auc is None


def test_all_zero_labels_baseline_is_zero(spark):
    r = evaluation.base_rate_baseline(spark.createDataFrame([(0.0,), (0.0,)], "label double")).first()
    assert r.base_rate == 0.0 and r.baseline_log_loss == 0.0


def test_ari_is_label_permutation_invariant(spark):
    a = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, c long")
    b = spark.createDataFrame([(i, (i // 2) % 4) for i in range(30)], "id long, t long")
    b2 = spark.createDataFrame([(i, 100 - (i // 2) % 4) for i in range(30)], "id long, t long")
    r1 = evaluation.adjusted_rand(a, b, "id", "c", "t").first().ari
    r2 = evaluation.adjusted_rand(a, b2, "id", "c", "t").first().ari
    assert r1 == r2
    same = evaluation.adjusted_rand(a, a.withColumnRenamed("c", "t"), "id", "c", "t").first().ari
    assert same == 1.0


def test_global_rank_independent_of_partitioning(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "id long, score double")
    r1 = {r.id: r.rank for r in evaluation.global_rank(df, "score", "id").collect()}
    r2 = {r.id: r.rank for r in evaluation.global_rank(df.repartition(13), "score", "id").collect()}
    assert r1 == r2
    expected = sorted(range(200), key=lambda i: (-(i % 7), i))
    assert [i for i, _ in sorted(r1.items(), key=lambda kv: kv[1])] == expected


def test_arm_without_rows_gets_uniform_prior(spark):
    stream = spark.createDataFrame([("t", "a", 1), ("t", "a", 0), ("t", "b", 0)], "test string, arm string, reward int")
    arms = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "c")], "test string, arm string")
    post = {r.arm: (r.alpha, r.beta) for r in campaign.beta_posterior(campaign.arm_counts(stream, arms=arms)).collect()}
    assert post == {"a": (2.0, 2.0), "b": (1.0, 2.0), "c": (1.0, 1.0)}


def test_p_best_sums_to_one_and_matches_closed_form(spark):
    # Two arms: P(X > Y) for Beta(3,1) vs Beta(1,3) = 1 - 1/20 ... computed by integration below.
    counts = spark.createDataFrame([("t", "a", 2, 0), ("t", "b", 0, 2)],
                                   "test string, arm string, successes long, failures long")
    g = {r.arm: r for r in campaign.grid_posterior(campaign.beta_posterior(counts)).collect()}
    assert g["a"].p_best + g["b"].p_best == pytest.approx(1.0, abs=1e-6)
    # X~Beta(3,1): f=3x^2; Y~Beta(1,3): F=1-(1-x)^3. P(X>Y)=int 3x^2 (1-(1-x)^3) dx = 1 - 3*B(3,4) = 1 - 1/20
    assert g["a"].p_best == pytest.approx(1 - 3 * math.gamma(3) * math.gamma(4) / math.gamma(7), abs=1e-4)


def test_winner_first_wins_ties(spark):
    s = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5), ("t", "c", 0.1)], "test string, arm string, p_best double")
    assert campaign.winner(s).first().winner == "a"


def test_too_few_converters_raises(spark):
    labels = spark.createDataFrame([(i, 1 if i < 5 else 0) for i in range(50)], "person_id long, converted_true int")
    with pytest.raises(ValueError):
        lookalike.seed_holdout(labels)


def test_null_scores_rank_last_and_do_not_count(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, None, 1), (3, 0.1, 0), (4, None, 0)], "id long, score double, label int")
    assert [r.id for r in evaluation.global_rank(df, "score", "id").orderBy("rank").collect()] == [1, 3, 2, 4]
    assert [r.id for r in evaluation.top_fraction(df, 0.25).collect()] == [1]
    r = evaluation.auc(df).first()
    assert (r.positives, r.negatives, r.auc) == (1, 1, 1.0)


def test_auc_of_huge_groups_does_not_overflow(spark):
    from unittest import mock

    from pyspark.sql import functions as F
    groups = spark.createDataFrame([(0.9, 10 ** 10, 0), (0.1, 0, 10 ** 10)], "score double, pos long, neg long")
    with mock.patch.object(evaluation, "score_groups", lambda *a: groups):
        assert evaluation.auc(groups.withColumn("label", F.lit(1))).first().auc == 1.0


def test_ranking_shuffles_rows_once(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("double").alias("score"))
    plan = evaluation.global_rank(df, "score", "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" not in plan.split("BroadcastExchange")[0]

