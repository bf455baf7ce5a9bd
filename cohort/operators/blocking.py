"""Blocking and candidate pairs.

Devices that share a signal value form a *block*; pairs are only formed inside
blocks of at most ``max_block`` distinct devices. A value shared by more
devices (public Wi-Fi IP, a shared test e-mail) carries no identity, and the
cap also bounds the work: at most C(max_block, 2) pairs per value, so no block
can explode quadratically.

The cap is a guard for *pairs*. Components need no pairs: :func:`star_edges` links every
member of a block to its smallest device, n - 1 edges for any block size, so
deterministic values link without a cap. Blocks left out of pairing are reported by
:func:`suppressed_blocks`.

Plan shape, chosen for skew: a single value may hold a large share of all
rows. Block sizes are computed with ``groupBy.count`` (map-side partial
aggregation, so a hot value costs one row per map task). The few oversized
values are copied to ``SALTS`` salts and removed by a ``left_anti`` join on
(value, salt of the device), so a hot value is spread whatever the session's skew settings
are. The pair self-join then only sees blocks of <= ``max_block`` rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.constants import DETERMINISTIC_TYPES, MAX_BLOCK, PROBABILISTIC_TYPES  # noqa: F401
from cohort.functions.expressions import choose2
from cohort.session import materialize

SALTS = 64
# Up to so many oversized blocks are broadcast, if they are counted already; more are joined by shuffle.
OVERSIZED_ROWS = 10_000


def _cap(max_block) -> F.Column:
    """Block cap as a column: one int for every type, or ``{type: cap}`` with
    the ``"*"`` entry (default ``MAX_BLOCK``) for types not listed."""
    if isinstance(max_block, dict):
        default = int(max_block.get("*", MAX_BLOCK))
        caps = {k: int(v) for k, v in max_block.items() if k != "*"}
        if not caps:
            return F.lit(default)
        m = F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(v))])
        return F.coalesce(m[F.col("block_type")], F.lit(default))
    return F.lit(int(max_block))


def _members(signals: DataFrame, types: Sequence[str], merge_types: bool) -> DataFrame:
    """Distinct ``(block_type, signal_value, device_id)`` memberships.

    With ``merge_types`` equal values of different types fall in one block
    (the reference keys only on the value); by default the key is
    ``(signal_type, signal_value)``. Null values never link.
    """
    s = signals.where(F.col("signal_type").isin(list(types)) & F.col("signal_value").isNotNull())
    btype = F.lit("*") if merge_types else F.col("signal_type")
    return s.select(btype.alias("block_type"), "signal_value", "device_id").distinct()


def linking_signals(signals: DataFrame) -> DataFrame:
    """The signals that may link devices: of a deterministic or probabilistic type, with a value."""
    types = list(DETERMINISTIC_TYPES + PROBABILISTIC_TYPES)
    return (signals.where(F.col("signal_type").isin(types) & F.col("signal_value").isNotNull())
                   .select("device_id", "signal_type", "signal_value"))


def block_members(signals: DataFrame) -> DataFrame:
    """Distinct ``[block_type, signal_value, device_id]`` of the linking types.

    What :func:`typed_pairs`, :func:`star_edges` and :func:`suppressed_blocks` are all derived from, to be
    written once where several are wanted (``typed_pairs_of``, ``star_edges_of``, ``suppressed_of``).
    """
    return _members(signals, DETERMINISTIC_TYPES + PROBABILISTIC_TYPES, False)


def oversized_blocks(members: DataFrame, max_block: int | dict = MAX_BLOCK) -> DataFrame:
    """``[block_type, signal_value, n_devices]`` of the blocks above the cap."""
    sizes = members.groupBy("block_type", "signal_value").agg(F.count(F.lit(1)).alias("n_devices"))
    return sizes.where(F.col("n_devices") > _cap(max_block))


def block_sizes(signals: DataFrame, types: Sequence[str] | None = None,
                max_block: int | dict = MAX_BLOCK, merge_types: bool = False) -> DataFrame:
    """Per block: distinct devices and whether it is usable for pairing.

    Usable = 2 <= n_devices <= max_block (inclusive cap; singletons form no pair).
    """
    if types is None:
        types = DETERMINISTIC_TYPES + PROBABILISTIC_TYPES
    m = _members(signals, types, merge_types)
    return (m.groupBy("block_type", "signal_value").agg(F.count(F.lit(1)).alias("n_devices"))
             .withColumn("usable", (F.col("n_devices") >= 2) & (F.col("n_devices") <= _cap(max_block))))


def self_pairs(signals: DataFrame, types: Sequence[str], max_block: int | dict = MAX_BLOCK,
               merge_types: bool = False) -> DataFrame:
    """Unordered device pairs ``[src, dst]`` (``src < dst``) sharing a usable block.

    ``max_block`` is one cap for every type or a ``{type: cap}`` dict.
    """
    return _pairs(_members(signals, types, merge_types), max_block).select("src", "dst").distinct()


def _without_oversized(members: DataFrame, max_block: int | dict, oversized: DataFrame | None = None) -> DataFrame:
    """Members of blocks within the cap (singletons stay; they form no pair).

    ``oversized``: :func:`oversized_blocks` of the members, if they are written already. Few of them are
    broadcast, so the members stay where they are.
    """
    block = ["block_type", "signal_value"]
    if oversized is not None and oversized.count() <= OVERSIZED_ROWS:
        return members.join(F.broadcast(oversized.select(*block)), block, "left_anti")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    oversized = (oversized_blocks(members, max_block) if oversized is None else oversized).select(*block, salts)
    salted = members.withColumn("salt", F.pmod(F.xxhash64("device_id"), F.lit(SALTS)).cast("int"))
    return salted.join(oversized, [*block, "salt"], "left_anti").drop("salt")


def _pairs(members: DataFrame, max_block: int | dict, oversized: DataFrame | None = None) -> DataFrame:
    """``[block_type, src, dst]`` with ``src < dst`` inside usable blocks, one row per shared block."""
    usable = _without_oversized(members, max_block, oversized)
    a = usable.withColumnRenamed("device_id", "src")
    b = usable.withColumnRenamed("device_id", "dst")
    return a.join(b, ["block_type", "signal_value"]).where(F.col("src") < F.col("dst"))


def star_edges(signals: DataFrame, types: Sequence[str] = DETERMINISTIC_TYPES, merge_types: bool = False) -> DataFrame:
    """``[src, dst]``: every device of a block linked to the block's smallest device; no cap.

    Gives the same components as all pairs of the block, in n - 1 edges. The centres (one row per
    shared value) are checkpointed: read back, they have no partitioning to keep, so the join
    shuffles both sides and AQE can split a hot value's members under default settings.
    """
    return star_edges_of(_members(signals, types, merge_types))


def star_edges_of(members: DataFrame) -> DataFrame:
    """:func:`star_edges` from distinct memberships (:func:`block_members`) of the types that are to link."""
    block = ["block_type", "signal_value"]
    centre = materialize(members.groupBy(*block).agg(F.min("device_id").alias("src"), F.count(F.lit(1)).alias("n"))
                                .where("n > 1").drop("n"))
    return (members.join(centre, block).where(F.col("src") < F.col("device_id"))
                   .select("src", F.col("device_id").alias("dst")).distinct())


def suppressed_blocks(signals: DataFrame, types: Sequence[str] | None = None, max_block: int | dict = MAX_BLOCK,
                      merge_types: bool = False) -> DataFrame:
    """Blocks above the cap: ``[block_type, value_hash, n_devices, pairs_not_formed]``.

    The value itself stays out of the report; ``value_hash`` is its SHA-256.
    """
    types = DETERMINISTIC_TYPES + PROBABILISTIC_TYPES if types is None else types
    return suppressed_of(oversized_blocks(_members(signals, types, merge_types), max_block))


def suppressed_of(oversized: DataFrame) -> DataFrame:
    """:func:`suppressed_blocks` from :func:`oversized_blocks`."""
    return oversized.select(
        "block_type", F.sha2("signal_value", 256).alias("value_hash"), "n_devices",
        choose2("n_devices").alias("pairs_not_formed"))


def typed_pairs(signals: DataFrame, det_types=DETERMINISTIC_TYPES, prob_types=PROBABILISTIC_TYPES,
                max_block: int | dict = MAX_BLOCK, merge_types: bool = False) -> DataFrame:
    """All linked pairs in one pass: ``[src, dst, deterministic, probabilistic]``.

    One member table, one block-size aggregate and one pair self-join for
    every signal type together (blocks stay keyed by type, so the cap is
    per type), then a single ``groupBy(src, dst)`` that records which kinds
    of block each pair shares. Probabilistic candidates not already linked
    are ``probabilistic and not deterministic``, so no separate anti join
    over pairs is needed.
    """
    det_types, prob_types = list(det_types), list(prob_types)
    s = signals.where(F.col("signal_type").isin(det_types + prob_types) & F.col("signal_value").isNotNull())
    is_det_type = F.col("signal_type").isin(det_types)
    # With ``merge_types`` equal values of different types *within a group*
    # (deterministic or probabilistic) share a block, as when each group is
    # paired on values alone; groups never share blocks.
    btype = (F.when(is_det_type, F.lit("det")).otherwise(F.lit("prob")) if merge_types
             else F.col("signal_type"))
    m = s.select(btype.alias("block_type"), "signal_value", "device_id").distinct()
    return typed_pairs_of(m, det_types + ["det"], max_block)


def typed_pairs_of(members: DataFrame, det_types=DETERMINISTIC_TYPES, max_block: int | dict = MAX_BLOCK,
                   oversized: DataFrame | None = None) -> DataFrame:
    """:func:`typed_pairs` from distinct memberships (:func:`block_members`) and, if written, their oversized blocks."""
    is_det = F.col("block_type").isin(list(det_types))
    return (_pairs(members, max_block, oversized).groupBy("src", "dst")
            .agg(F.max(is_det).alias("deterministic"), F.max(~is_det).alias("probabilistic")))


def deterministic_edges(signals: DataFrame, max_block: int | dict = MAX_BLOCK) -> DataFrame:
    """Pairs sharing a hashed e-mail or MAID."""
    return self_pairs(signals, DETERMINISTIC_TYPES, max_block)


def ip_candidates(signals: DataFrame, max_block: int | dict = MAX_BLOCK) -> DataFrame:
    """Pairs sharing a (small) IP block: candidates for the probabilistic matcher."""
    return self_pairs(signals, PROBABILISTIC_TYPES, max_block)


def new_candidates(candidates: DataFrame, linked: DataFrame) -> DataFrame:
    """Candidate pairs not already linked (J4/U3), by ``left_anti`` on (src, dst)."""
    return candidates.join(linked.select("src", "dst"), ["src", "dst"], "left_anti")


def union_edges(*edge_sets: DataFrame) -> DataFrame:
    """Union of canonical edge sets, deduplicated."""
    out = edge_sets[0].select("src", "dst")
    for e in edge_sets[1:]:
        out = out.unionByName(e.select("src", "dst"))
    return out.distinct()
