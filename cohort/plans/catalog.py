"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables under ``sf_dir`` through the ``fx_*``
stand-in views and runs one engine operator (or a composition) over the
whole tables. ``cohort.plans.sql_twins`` holds the DuckDB twin of every
query that has an exact SQL equivalent.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.functions.expressions import pseudonymize
from cohort.operators import (affinity, blocking, campaign, consent, ctr, evaluation, graph, lookalike, matcher,
                              propensity, segments, split)
from cohort.plans import identity, metrics, models, segmentation
from cohort.session import materialize
from cohort.sources.contracts import contract_check
from cohort.sources.fixtures import Fixtures, campaign_stream_from
from cohort.streaming import arm_posteriors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _gated(spark: SparkSession, sf_dir: str) -> identity.Gated:
    fx = _fx(spark, sf_dir)
    return identity.gate(fx.persons(), fx.devices(), fx.signals(), fx.events())


# ----------------------------- sources / privacy --------------------------- #

@register
def q_contract_check(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return contract_check({"persons": fx.persons(), "devices": fx.devices(),
                           "identity_signals": fx.signals(), "events": fx.events(),
                           "interactions": affinity.interactions(fx.events(), fx.devices()),
                           "campaign_stream": fx.campaign_stream()})


@register
def q_consent_flag(spark, sf_dir):
    p = consent.with_processing_allowed(_fx(spark, sf_dir).persons())
    return p.select("person_id", "region", "processing_allowed")


@register
def q_pseudonymize(spark, sf_dir):
    d = _fx(spark, sf_dir).devices()
    return d.select("device_id",
                    pseudonymize("person_id").alias("person_pid"),
                    pseudonymize("person_id", salt="cohort").alias("person_pid_salted"),
                    pseudonymize(F.lit("dev"), "device_id").alias("device_pid"))


@register
def q_consent_report(spark, sf_dir):
    return consent.consent_report(_fx(spark, sf_dir).persons())


@register
def q_device_suppression(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return consent.device_suppression(fx.devices(), fx.persons())


@register
def q_gate_devices(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return consent.gate_devices(fx.devices(), fx.persons())


@register
def q_gate_events(spark, sf_dir):
    return _gated(spark, sf_dir).events


# ----------------------------- blocking / edges ---------------------------- #

@register
def q_block_sizes(spark, sf_dir):
    return blocking.block_sizes(_gated(spark, sf_dir).signals)


@register
def q_suppressed_blocks(spark, sf_dir):
    """Blocks above the pair cap and the pairs they would have formed."""
    return blocking.suppressed_blocks(_gated(spark, sf_dir).signals)


@register
def q_star_edges(spark, sf_dir):
    """Uncapped links of every device to the smallest device that shares a deterministic value."""
    return blocking.star_edges(_gated(spark, sf_dir).signals)


@register
def q_resolve_identities_fixed(spark, sf_dir):
    """Whole resolution with fixed matcher coefficients: component of every device."""
    return identity.fixed_resolution(_gated(spark, sf_dir))[1]


@register
def q_identity_ablation_fixed(spark, sf_dir):
    """Pairwise precision, recall and F1 without and with the fixed matcher's links."""
    return identity.fixed_resolution(_gated(spark, sf_dir))[2]


@register
def q_det_edges(spark, sf_dir):
    return blocking.deterministic_edges(_gated(spark, sf_dir).signals)


@register
def q_ip_candidates(spark, sf_dir):
    return blocking.ip_candidates(_gated(spark, sf_dir).signals)


@register
def q_new_candidates(spark, sf_dir):
    s = _gated(spark, sf_dir).signals
    return blocking.new_candidates(blocking.ip_candidates(s), blocking.deterministic_edges(s))


@register
def q_edge_union(spark, sf_dir):
    s = _gated(spark, sf_dir).signals
    return blocking.union_edges(blocking.deterministic_edges(s), blocking.ip_candidates(s))


# ----------------------------- graph ------------------------------------- #

@register
def q_connected_components(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return graph.connected_components(g.nodes, blocking.star_edges(g.signals))


@register
def q_pairwise_prf(spark, sf_dir):
    _, _, prf = identity.deterministic_resolution(_gated(spark, sf_dir))
    return prf


@register
def q_graph_counts(spark, sf_dir):
    g = _gated(spark, sf_dir)
    pairs = identity.linked_pairs(g)
    det, cands = identity.deterministic_from(pairs), identity.candidates_from(pairs)
    labels = graph.connected_components(g.nodes, blocking.star_edges(g.signals))
    return graph.graph_counts(g.nodes, g.truth, labels,
                              {"deterministic_edges": det, "candidate_pairs": cands})


# ----------------------------- features ---------------------------------- #

def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@register
def q_affinity_long(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return affinity.person_long(g.all_events, g.devices)


@register
def q_affinity_wide(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return affinity.person_affinity(g.all_events, g.devices)


@register
def q_interactions(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return affinity.interactions(g.all_events, g.devices)


@register
def q_unit_vectors(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return _round(affinity.unit_vectors_long(g.events), ["u"])


def _candidate_features(g: identity.Gated) -> DataFrame:
    return identity.candidate_features(g)


@register
def q_pair_cosine(spark, sf_dir):
    f = _candidate_features(_gated(spark, sf_dir))
    return _round(f.select("src", "dst", "cosine"), ["cosine"])


@register
def q_pair_features(spark, sf_dir):
    return _round(_candidate_features(_gated(spark, sf_dir)), ["cosine"])


def _person_affinity(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    persons = fx.persons()
    g = identity.gate(persons, fx.devices(), fx.signals(), fx.events())
    # Written once: standardising reads it for the statistics and again for the output.
    return persons, materialize(affinity.person_affinity(g.all_events, g.devices))


@register
def q_standardize(spark, sf_dir):
    _, wide = _person_affinity(spark, sf_dir)
    return _round(affinity.standardize(wide, affinity.CATS, keep=["person_id"]), affinity.CATS)


@register
def q_propensity_features(spark, sf_dir):
    persons, wide = _person_affinity(spark, sf_dir)
    return propensity.propensity_features(wide, persons)


@register
def q_hash_split(spark, sf_dir):
    return split.hash_split(_fx(spark, sf_dir).persons().select("person_id"), "person_id")


# ----------------------------- scores and ranking ------------------------- #

@register
def q_precision_threshold(spark, sf_dir):
    f = _candidate_features(_gated(spark, sf_dir))
    t = evaluation.precision_threshold(f, score="cosine", label="label")
    return _round(t, ["threshold", "precision"])


@register
def q_auc(spark, sf_dir):
    f = _candidate_features(_gated(spark, sf_dir))
    return evaluation.auc(f, score="cosine", label="label")


@register
def q_log_loss(spark, sf_dir):
    f = _candidate_features(_gated(spark, sf_dir))
    return evaluation.log_loss(f, prob="cosine", label="label")


def _impressions(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return ctr.impressions(g.all_events, g.devices)


@register
def q_ctr_baseline(spark, sf_dir):
    imp = split.hash_split(_impressions(spark, sf_dir), "event_id")
    train = imp.where(F.col("split") == "train").withColumn("label", F.col("click").cast("double"))
    return evaluation.base_rate_baseline(train)


@register
def q_adjusted_rand(spark, sf_dir):
    g = _gated(spark, sf_dir)
    labels = graph.connected_components(g.nodes, blocking.star_edges(g.signals))
    return evaluation.adjusted_rand(labels, g.truth, "id", "component", "person")


def _segment_means(spark, sf_dir):
    persons, wide = _person_affinity(spark, sf_dir)
    z = affinity.standardize(wide, affinity.CATS, keep=["person_id"])
    assign = persons.select("person_id", F.col("true_segment").cast("int").alias("cluster"))
    members = assign.join(wide.select("person_id"), "person_id", "left_semi")
    return members, segments.cluster_means(assign, z, "person_id", "cluster", affinity.CATS), assign


@register
def q_top2_per_group(spark, sf_dir):
    _, means, _ = _segment_means(spark, sf_dir)
    t = evaluation.top_n_per_group(means, "cluster", "value", "idx", segments.TOP_DIMS)
    return _round(t.select("cluster", "dim", "value", "rank"), ["value"])


@register
def q_segment_names(spark, sf_dir):
    members, means, assign = _segment_means(spark, sf_dir)
    names = segments.segment_names(means, "cluster")
    # Cluster ids are 0..k-1 with k read from the labels (empty clusters still get a row).
    k = assign.agg(F.max("cluster").alias("k")).first()["k"] + 1
    sizes = segments.segment_sizes(members, k, "cluster")
    return names.join(sizes, "cluster", "right").select("cluster", "label", "size").orderBy("cluster")


# ----------------------------- lookalike ---------------------------------- #

def _lookalike_inputs(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    persons = fx.persons()
    g = identity.gate(persons, fx.devices(), fx.signals(), fx.events())
    # Written once: the users, the labels, the item means and the scores all read it.
    inter = materialize(affinity.interactions(g.all_events, g.devices))
    users = inter.select("person_id").distinct()
    labels = users.join(persons.select("person_id", "converted_true"), "person_id")
    return inter, users, labels


@register
def q_ratings(spark, sf_dir):
    inter, _, _ = _lookalike_inputs(spark, sf_dir)
    return lookalike.ratings(inter)


@register
def q_seed_holdout(spark, sf_dir):
    _, _, labels = _lookalike_inputs(spark, sf_dir)
    return lookalike.seed_holdout(labels)


@register
def q_seed_overindex(spark, sf_dir):
    inter, users, labels = _lookalike_inputs(spark, sf_dir)
    roles = lookalike.seed_holdout(labels)
    return _round(lookalike.seed_overindex(inter, users, roles), ["uplift"])


def _observed_audience(spark, sf_dir):
    inter, users, labels = _lookalike_inputs(spark, sf_dir)
    roles = lookalike.seed_holdout(labels)
    char = lookalike.seed_overindex(inter, users, roles)
    return lookalike.expand(lookalike.observed_scores(inter, users, char), roles)


@register
def q_top_fraction(spark, sf_dir):
    a = _observed_audience(spark, sf_dir)
    return a.where("selected").select("person_id", "score", "rank")


@register
def q_lookalike_lift(spark, sf_dir):
    return lookalike.lookalike_lift(_observed_audience(spark, sf_dir))


# ----------------------------- campaign ----------------------------------- #

def _stream(spark, sf_dir):
    s = _fx(spark, sf_dir).campaign_stream()
    return s.select(F.lit("fx").alias("test"), "round", "batch", F.col("creative").alias("arm"), "reward")


def _posterior(spark, sf_dir):
    return campaign.beta_posterior(campaign.arm_counts(_stream(spark, sf_dir)))


@register
def q_beta_posterior(spark, sf_dir):
    return _round(_posterior(spark, sf_dir), ["posterior_mean", "posterior_sd"])


def _grid(spark, sf_dir):
    return campaign.grid_posterior(_posterior(spark, sf_dir))


@register
def q_credible_interval(spark, sf_dir):
    return _round(_grid(spark, sf_dir).select("test", "arm", "ci_low", "ci_high", "grid_points"),
                  ["ci_low", "ci_high"])


@register
def q_p_best(spark, sf_dir):
    return _round(_grid(spark, sf_dir).select("test", "arm", "p_best"), ["p_best"])


@register
def q_ab_winner(spark, sf_dir):
    return _round(campaign.winner(_grid(spark, sf_dir)), ["p_best"])


@register
def q_budget_share(spark, sf_dir):
    return _round(_grid(spark, sf_dir).select("test", "arm", F.col("p_best").alias("share")), ["share"])


@register
def q_beats_control(spark, sf_dir):
    """P(arm beats the first arm), per arm."""
    return _round(campaign.beats_control(_posterior(spark, sf_dir)), ["p_beats"], 3)


@register
def q_winner_truth(spark, sf_dir):
    """The declared winner beside the arm whose true rate is highest."""
    truth = _fx(spark, sf_dir).campaign_truth().select(F.lit("fx").alias("test"), F.col("creative").alias("arm"), "true_rate")
    return _round(campaign.winner_against_truth(campaign.winner(_grid(spark, sf_dir)), truth), ["p_best"])


@register
def q_bandit_replay(spark, sf_dir):
    r = campaign.bandit_replay(_stream(spark, sf_dir)).withColumn("batch", F.col("batch").cast("string"))
    cols = ["policy_rate", "uniform_rate", "best_rate", "best_share", "thompson_regret", "uniform_regret",
            "cum_thompson_regret", "cum_uniform_regret", "regret_reduction", "cum_best_share"]
    return _round(r, cols)


@register
def q_uniform_regret(spark, sf_dir):
    post = _posterior(spark, sf_dir)
    n = post.groupBy("test").agg(F.sum("trials").alias("n_rounds"))
    r = campaign.uniform_regret(post.join(n, "test"))
    return _round(r, ["best_rate", "mean_rate", "uniform_regret"])


@register
def q_eb_pooling(spark, sf_dir):
    """Empirical-Bayes pooled posteriors: campaign = test, creative = arm, click = reward."""
    ev = _gated(spark, sf_dir).events
    counts = campaign.arm_counts(ev.select(F.col("campaign").alias("test"), F.col("creative").alias("arm"),
                                           F.col("click").alias("reward")))
    prior = campaign.eb_prior(counts)
    post = campaign.beta_posterior(counts.join(prior, "test"), F.col("prior_alpha"), F.col("prior_beta"))
    return _round(post.select("test", "arm", "successes", "failures", "prior_alpha", "prior_beta",
                              "posterior_mean"), ["prior_alpha", "prior_beta", "posterior_mean"])


# ----------------------------- learned models (rows-only checks) ----------- #

def _resolution(spark, sf_dir, activity=None):
    fx = _fx(spark, sf_dir)
    return identity.resolve_identities(fx.persons(), fx.devices(), fx.signals(), fx.events(), activity=activity)


@register
def q_matcher_scores(spark, sf_dir):
    return matcher.train_matcher(identity.candidate_features(_gated(spark, sf_dir))).scored


@register
def q_matcher_report(spark, sf_dir):
    return matcher.train_matcher(identity.candidate_features(_gated(spark, sf_dir))).report


@register
def q_identity_ablation(spark, sf_dir):
    return _resolution(spark, sf_dir).ablation


@register
def q_resolve_identities(spark, sf_dir):
    return _resolution(spark, sf_dir).full_labels


def _segmentation(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    persons = fx.persons()
    g = identity.gate(persons, fx.devices(), fx.signals(), fx.events())
    return segmentation.segment_people(g, persons)


@register
def q_kmeans_grid(spark, sf_dir):
    return _segmentation(spark, sf_dir).silhouette


@register
def q_kmeans_segments(spark, sf_dir):
    return _segmentation(spark, sf_dir).named


@register
def q_gmm_segments(spark, sf_dir):
    return _segmentation(spark, sf_dir).ari


def _gp(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    persons = fx.persons()
    return identity.gate(persons, fx.devices(), fx.signals(), fx.events()), persons


@register
def q_propensity_lr(spark, sf_dir):
    g, persons = _gp(spark, sf_dir)
    return models.propensity_models(g, persons, with_gbt=False).scores


@register
def q_propensity_gbt(spark, sf_dir):
    g, persons = _gp(spark, sf_dir)
    return models.propensity_models(g, persons).report


@register
def q_ctr_hashed(spark, sf_dir):
    g = _gated(spark, sf_dir)
    return ctr.hashed_features(ctr.impressions(g.all_events, g.devices))


@register
def q_ctr_scores(spark, sf_dir):
    return models.ctr_model(_gated(spark, sf_dir)).report


@register
def q_als_factors(spark, sf_dir):
    g, persons = _gp(spark, sf_dir)
    return models.als_lookalike(g, persons).user_factors


@register
def q_lookalike_audience(spark, sf_dir):
    g, persons = _gp(spark, sf_dir)
    return models.als_lookalike(g, persons).audience.where("selected")


@register
def q_metrics_summary(spark, sf_dir):
    """Long ``[module, metric, value]`` table over all modules."""
    fx = _fx(spark, sf_dir)
    g, persons = _gp(spark, sf_dir)
    # The impressions are joined and summed by person once for propensity and lookalike; the resolution lists
    # its categories from these sums. The segmentation keeps its own: K-means starts depend on the order of rows.
    sums = materialize(affinity.person_sums(g.all_events, g.devices))
    seg = segmentation.segment_people(g, persons)
    res = _resolution(spark, sf_dir, activity=sums)
    ablation = materialize(res.ablation)  # two rows, read by three metrics
    post = campaign.beta_posterior(campaign.arm_counts(_stream(spark, sf_dir)))
    grid = campaign.grid_posterior(post)
    return metrics.summary({
        "consent": metrics.wide_to_long(consent.consent_report(fx.persons())),
        "identity": metrics.union_long([
            res.matcher.report,
            metrics.wide_to_long(ablation.where(F.col("variant") == "deterministic_only")
                                 .drop("variant"), prefix="det_"),
            metrics.wide_to_long(ablation.where(F.col("variant") != "deterministic_only")
                                 .drop("variant"), prefix="full_"),
            metrics.wide_to_long(identity.f1_lift(ablation)),
            res.counts(),
            res.suppressed.groupBy(F.concat(F.lit("suppressed_blocks_"), "block_type").alias("metric"))
                          .agg(F.count(F.lit(1)).cast("double").alias("value"))]),
        "segmentation": seg.ari.select(F.concat(F.lit("ari_"), "model").alias("metric"), F.col("ari").alias("value")),
        "propensity": models.propensity_models(g, persons, sums=sums).report,
        "ctr": models.ctr_model(g).report,
        "lookalike": metrics.wide_to_long(models.als_lookalike(g, persons, sums=sums).lift),
        "campaign": metrics.wide_to_long(campaign.winner(grid).drop("test", "winner"), prefix="winner_"),
    })


# ----------------------------- streaming ---------------------------------- #

@register
def q_stream_posterior(spark, sf_dir):
    """Arm posteriors maintained by a streaming aggregation over the events files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = campaign_stream_from(arm_posteriors.read_stream_table(spark, sf_dir, "events", schema))
    stream = rows.select(F.lit("fx").alias("test"), F.col("creative").alias("arm"), "reward")
    out, ckpt = arm_posteriors.scratch_paths(spark, "stream-posterior")
    arm_posteriors.run_available(arm_posteriors.posterior_stream(stream), out, ckpt)
    return _round(spark.read.parquet(out), ["posterior_mean", "posterior_sd"]).select(
        "test", "arm", "successes", "failures", "trials", "alpha", "beta", "posterior_mean", "posterior_sd")


@register
def q_resolved_affinity(spark, sf_dir):
    """Person affinity keyed by the *resolved* entity instead of the truth id."""
    g = _gated(spark, sf_dir)
    labels = graph.connected_components(g.nodes, blocking.star_edges(g.signals))
    resolved = g.devices.join(labels.select(F.col("id").alias("device_id"), F.col("component").alias("entity")),
                              "device_id").select("device_id", F.col("entity").alias("person_id"), "device_type")
    return affinity.person_affinity(g.all_events, resolved).withColumnRenamed("person_id", "entity")


@register
def q_embedding_segments(spark, sf_dir):
    """K-means (k = number of labels) on the embeddings table, ARI vs. its labels."""
    emb = _fx(spark, sf_dir).raw("embeddings")
    data = segments.array_features(emb, "embedding").select("vec_id", "features", "label")
    data = materialize(data)
    k = data.agg(F.count_distinct("label").alias("k")).first()["k"]
    model = segments.KMeans(k=k, seed=segments.SEED, featuresCol="features").fit(data)
    pred = model.transform(data).select("vec_id", F.col("prediction").alias("cluster"))
    return evaluation.adjusted_rand(pred, data.select("vec_id", "label"), "vec_id", "cluster", "label") \
                     .withColumn("k", F.lit(k))


@register
def q_logging_balance(spark, sf_dir):
    """Per batch: distance of the logged arm allocation from uniform (replay precondition)."""
    b = campaign.logging_balance(_stream(spark, sf_dir)).withColumn("batch", F.col("batch").cast("string"))
    return _round(b, ["max_share_gap"])


@register
def q_stream_windowed_posterior(spark, sf_dir):
    """Daily (event-time window) arm posteriors from a watermarked streaming aggregation."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = campaign_stream_from(arm_posteriors.read_stream_table(spark, sf_dir, "events", schema))
    stream = rows.select(F.lit("fx").alias("test"), F.col("creative").alias("arm"), "reward",
                         arm_posteriors.event_time("ts").alias("ts"))
    out, ckpt = arm_posteriors.scratch_paths(spark, "stream-windowed")
    post = arm_posteriors.posterior_stream(stream, ts="ts", window="1 day", watermark="1 day")
    arm_posteriors.run_available(post, out, ckpt, windowed=True)
    latest = arm_posteriors.latest(spark.read.parquet(out), ["window", "test", "arm"])
    return _round(latest.select(arm_posteriors.window_day("window").alias("day"), "test", "arm",
                                "successes", "failures", "posterior_mean"), ["posterior_mean"])
