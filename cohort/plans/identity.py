"""Identity-resolution plan (I13): consent gate -> deterministic edges ->
probabilistic matcher on IP candidates -> connected components -> pairwise
evaluation, as one function returning DataFrames.

Ground truth (``devices.person_id``) is used only to label training pairs and
to evaluate; the resolver itself never reads it.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.operators import affinity, blocking, consent, graph, matcher
from cohort.operators.evaluation import pairwise_prf
from cohort.session import materialize


@dataclass
class Gated:
    devices: DataFrame
    signals: DataFrame
    events: DataFrame
    # Ungated events, for operators whose own join with ``devices`` is the gate.
    all_events: DataFrame

    @property
    def nodes(self) -> DataFrame:
        return self.devices.select(F.col("device_id").alias("id"))

    @property
    def truth(self) -> DataFrame:
        return self.devices.select(F.col("device_id").alias("id"), F.col("person_id").alias("person"))


def gate(persons: DataFrame, devices: DataFrame, signals: DataFrame, events: DataFrame) -> Gated:
    """Apply the consent gate once; everything downstream sees only these."""
    kept = consent.gate_devices(devices, persons)
    return Gated(kept,
                 consent.gate_by_devices(signals, kept),
                 consent.gate_by_devices(events, kept), events)


def deterministic_resolution(g: Gated, max_block: int | dict = blocking.MAX_BLOCK):
    """Components over deterministic values and their pairwise PRF.

    The pairs are capped (``max_block``); the components come from uncapped star edges.
    """
    det = blocking.deterministic_edges(g.signals, max_block)
    labels = graph.connected_components(g.nodes, blocking.star_edges(g.signals))
    return det, labels, pairwise_prf(labels, g.truth)


def linked_pairs(g: Gated, max_block: int | dict = blocking.MAX_BLOCK) -> DataFrame:
    """Deterministic and probabilistic pairs in one blocking pass (see ``blocking.typed_pairs``)."""
    return blocking.typed_pairs(g.signals, max_block=max_block)


def deterministic_from(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("deterministic")).select("src", "dst")


def candidates_from(pairs: DataFrame) -> DataFrame:
    """IP-blocked pairs not already linked deterministically."""
    return pairs.where(F.col("probabilistic") & ~F.col("deterministic")).select("src", "dst")


def candidate_features(g: Gated, pairs: DataFrame | None = None, max_block: int | dict = blocking.MAX_BLOCK,
                       profiles: DataFrame | None = None, cats: list[str] | None = None) -> DataFrame:
    """IP-blocked pairs not already linked, with behavioural features.

    Positional ``profiles`` come with the ``cats`` they were built from.
    """
    if pairs is None:
        pairs = linked_pairs(g, max_block)
    if profiles is None:
        cats = affinity.categories(g.all_events)
        profiles = affinity.device_profiles(g.devices, g.all_events, cats)
    return affinity.pair_features(candidates_from(pairs), profiles, None if cats is None else len(cats))


@dataclass
class Resolution:
    det_edges: DataFrame
    prob_edges: DataFrame
    det_labels: DataFrame
    full_labels: DataFrame
    matcher: matcher.Matcher
    ablation: DataFrame      # [variant, tp, predicted_pairs, true_pairs, precision, recall, f1]
    gated: Gated
    suppressed: DataFrame    # [block_type, value_hash, n_devices, pairs_not_formed]

    def counts(self) -> DataFrame:
        """Graph sizes of the full resolution (devices, persons, entities, edges)."""
        return graph.graph_counts(self.gated.nodes, self.gated.truth, self.full_labels,
                                  {"deterministic_edges": self.det_edges, "probabilistic_edges": self.prob_edges})


def resolve_identities(persons: DataFrame, devices: DataFrame, signals: DataFrame, events: DataFrame,
                       max_block: int | dict = blocking.MAX_BLOCK, activity: DataFrame | None = None) -> Resolution:
    """Full identity resolution with the deterministic-only ablation.

    Gated devices, the distinct members of the linking blocks, the blocks above the cap, the linked pairs
    (deterministic and probabilistic, from one blocking pass), the per-device profiles and the labels are each
    read several times downstream, so each is written once to the checkpoint directory
    instead of being recomputed from the raw tables at every reference.

    ``activity``: any written table whose ``content_cat`` holds every category of the gated devices; the
    categories are listed from it and not from the events.
    """
    kept = materialize(consent.gate_devices(devices, persons))
    g = Gated(kept, consent.gate_by_devices(signals, kept), consent.gate_by_devices(events, kept), events)
    members = materialize(blocking.block_members(blocking.linking_signals(g.signals)))
    oversized = materialize(blocking.oversized_blocks(members, max_block))
    pairs = materialize(blocking.typed_pairs_of(members, max_block=max_block, oversized=oversized))
    det = deterministic_from(pairs)
    # Listed once, for the vectors and for their comparison.
    cats = affinity.categories(g.all_events if activity is None else activity)
    profiles = materialize(affinity.device_profiles(g.devices, g.all_events, cats))
    feat = candidate_features(g, pairs, max_block, profiles, cats)
    m = matcher.train_matcher(feat)
    prob = materialize(matcher.accepted_edges(m))
    linking = members.where(F.col("block_type").isin(list(blocking.DETERMINISTIC_TYPES)))
    det_labels = materialize(graph.connected_components(g.nodes, blocking.star_edges_of(linking)))
    # Adding the probabilistic links contracts the deterministic components
    # first, so the second labelling iterates over components, not devices.
    full_labels = materialize(graph.merge_components(det_labels, prob))
    ablation = (pairwise_prf(det_labels, g.truth).select(F.lit("deterministic_only").alias("variant"), "*")
                .unionByName(pairwise_prf(full_labels, g.truth)
                             .select(F.lit("deterministic_plus_probabilistic").alias("variant"), "*")))
    return Resolution(det, prob, det_labels, full_labels, m, ablation, g,
                      blocking.suppressed_of(oversized))


# Coefficients for a resolution without training: any fixed values do, as the same are used in its check.
FIXED_COEFFICIENTS = {"intercept": -2.0, "cosine": 5.0, "same_type": 0.5}
FIXED_THRESHOLD = 0.75


def fixed_resolution(g: Gated, coefficients: dict[str, float] | None = None, threshold: float = FIXED_THRESHOLD,
                     max_block: int | dict = blocking.MAX_BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolution with given matcher coefficients: ``(accepted pairs, labels, ablation)``.

    Same steps as :func:`resolve_identities` (features, score, threshold, components,
    PRF), without fitting, so every step has one right answer.
    """
    c = FIXED_COEFFICIENTS if coefficients is None else coefficients
    pairs = materialize(linked_pairs(g, max_block))
    feat = candidate_features(g, pairs, max_block)
    logit = (F.lit(c["intercept"]) + F.lit(c["cosine"]) * F.round("cosine", 9) + F.lit(c["same_type"]) * F.col("same_type"))
    accepted = materialize(feat.withColumn("p", 1 / (1 + F.exp(-logit))).where(F.col("p") >= threshold)
                               .select("src", "dst"))
    det_labels = materialize(graph.connected_components(g.nodes, blocking.star_edges(g.signals)))
    labels = materialize(graph.merge_components(det_labels, accepted))
    ablation = (pairwise_prf(det_labels, g.truth).select(F.lit("deterministic_only").alias("variant"), "*")
                .unionByName(pairwise_prf(labels, g.truth)
                             .select(F.lit("deterministic_plus_probabilistic").alias("variant"), "*")))
    return accepted, labels, ablation


def f1_lift(ablation: DataFrame) -> DataFrame:
    """F1(full) - F1(deterministic only) as one row."""
    return ablation.agg(
        (F.max(F.when(F.col("variant") == "deterministic_plus_probabilistic", F.col("f1")))
         - F.max(F.when(F.col("variant") == "deterministic_only", F.col("f1")))).alias("f1_lift"))
