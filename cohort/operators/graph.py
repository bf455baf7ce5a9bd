"""Undirected graph operators.

Connected components use the alternating *large-star* / *small-star*
contraction of Kiveris et al. (SoCC 2014). Each round is two
``groupBy``+``join`` steps over the edge list; rounds grow with log of the
component diameter instead of the diameter itself (label propagation needs
one round per hop, so a long chain never finishes in a fixed budget).

Skew: a node whose edges are ``1 / HUB_SHARE`` of all edges or more is a hub; by
that definition there are at most ``2 * HUB_SHARE`` of them, whatever the graph.
Values of hubs reach their edges by a broadcast of that bounded list, so a hub's
edges stay where they are; the other edges meet the node table in a shuffle
where no key can hold more than that share. This does not depend on AQE or its
thresholds. Minima and degrees per node are summed on the map side first. No step
collects a node's neighbourhood into one task.

Lineage is cut every round with reliable checkpoints of the node table, the
large-star output and the edge set (see ``cohort.session.materialize``), so a lost
executor recomputes at most one step. Convergence is read off the same per-node aggregate that drives the
large-star step: the edge set is a forest of stars centred on each
component's minimum exactly when no node has both smaller and larger
neighbours and no node has two smaller neighbours.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.session import materialize

DEFAULT_MAX_ROUNDS = 100
# A hub has at least one in ``HUB_SHARE`` of all edges, and no fewer than ``HUB_LEAST``.
HUB_SHARE = 1024
HUB_LEAST = 512


def symmetrize(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Both directions of every edge in one scan: ``[u, v]``."""
    pair = F.array(F.struct(F.col(src).alias("u"), F.col(dst).alias("v")),
                   F.struct(F.col(dst).alias("u"), F.col(src).alias("v")))
    return edges.select(F.explode(pair).alias("e")).select("e.u", "e.v")


def hub_limit(n_edges: int) -> int:
    """Least degree of a hub: at most ``2 * HUB_SHARE`` nodes of ``n_edges`` edges reach it."""
    return max(HUB_LEAST, -(-n_edges // HUB_SHARE))


def at_nodes(rows: DataFrame, key: str, table: DataFrame, limit: int | None) -> DataFrame:
    """``rows`` joined with the columns of ``table`` (one row per ``key``, with its ``degree`` in rows).

    ``limit`` is None if no key has :func:`hub_limit` rows: a plain join. Otherwise keys of ``limit`` rows or more are looked up in a broadcast of those few table rows, all others
    in a shuffled join. ``rows`` is read twice and should be a written or cached table.
    """
    if limit is None:
        return rows.join(table.drop("degree"), key)
    hubs = F.broadcast(table.where(F.col("degree") >= limit).drop("degree"))
    others = table.where(F.col("degree") < limit).drop("degree")
    light = rows.join(hubs.select(key), key, "left_anti").join(others, key)
    return rows.join(hubs, key).unionByName(light)


def _endpoints(e: DataFrame, values: DataFrame, a: str, b: str) -> DataFrame:
    """``[u, degree, ...]`` of every endpoint of ``e``, with the columns of ``values[u, ...]`` (null if absent)."""
    ends = symmetrize(e, a, b).groupBy("u").agg(F.count(F.lit(1)).alias("degree"))
    return ends.join(values, "u", "left")


def canonical_edges(nodes: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct undirected edges as ``[hi, lo]`` (``hi > lo``), a written table.

    Self-loops are dropped, duplicates and reversed copies collapse, and an
    edge with an endpoint that is not a node is dropped (it never bridges).
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a") != F.col("b"))
    e = materialize(e.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    ids = nodes.select(F.col("id").alias("u")).distinct().withColumn("known", F.lit(True))
    ends = materialize(_endpoints(e, ids, "hi", "lo"))
    row = ends.agg(F.sum("degree").alias("n"), F.count_if(F.col("known").isNull()).alias("unknown")).first()
    if not row["unknown"]:
        return e
    limit = hub_limit(row["n"] // 2)
    for end in ("hi", "lo"):
        known = ends.select(F.col("u").alias(end), "degree", "known")
        e = materialize(at_nodes(e, end, known, limit).where("known").select("hi", "lo"))
    return e


def _node_stats(e: DataFrame) -> DataFrame:
    """Per node u: min neighbour, number of smaller and larger neighbours."""
    sym = symmetrize(e, "hi", "lo")
    return sym.groupBy("u").agg(
        F.min("v").alias("m"),
        F.count_if(F.col("v") < F.col("u")).alias("n_lt"),
        F.count_if(F.col("v") > F.col("u")).alias("n_gt"))


def _large_star(e: DataFrame, stats: DataFrame, limit: int | None) -> DataFrame:
    """Link every neighbour larger than u to min(u, N(u))."""
    up = symmetrize(e, "hi", "lo").where(F.col("v") > F.col("u"))
    mu = stats.select("u", F.least(F.col("u"), F.col("m")).alias("mu"), (F.col("n_lt") + F.col("n_gt")).alias("degree"))
    return at_nodes(up, "u", mu, limit).select(F.col("v").alias("hi"), F.col("mu").alias("lo")).distinct()


def _small_star(e: DataFrame, minima: DataFrame, limit: int | None) -> DataFrame:
    """Link u and every neighbour smaller than u to the minimum of them, ``minima[u, m, degree]``."""
    down = e.select(F.col("hi").alias("u"), F.col("lo").alias("v"))          # v < u
    moved = (at_nodes(down, "u", minima, limit).where(F.col("v") != F.col("m"))
             .select(F.col("v").alias("hi"), F.col("m").alias("lo")))
    anchor = minima.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(anchor).distinct()


def _smaller(e: DataFrame) -> DataFrame:
    """``[u, m, degree]``: least of the smaller neighbours and their number."""
    return e.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("degree"))


def connected_components(nodes: DataFrame, edges: DataFrame, *, id_col: str = "id",
                         src: str = "src", dst: str = "dst",
                         max_rounds: int = DEFAULT_MAX_ROUNDS) -> DataFrame:
    """Label every node with the minimum id of its component: ``[id, component]``.

    ``nodes[id_col]`` may be numeric or string; ``edges[src, dst]`` are
    undirected. Isolated nodes keep their own id. Runs to convergence and
    raises if ``max_rounds`` rounds do not suffice (never returns a partial
    labelling silently).
    """
    ids = nodes.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    e = canonical_edges(ids, edges, src, dst)
    for _ in range(max_rounds):
        # One row per node, written: it is read by the test below and by the large star.
        stats = materialize(_node_stats(e))
        not_star = ((F.col("n_lt") > 0) & (F.col("n_gt") > 0)) | (F.col("n_lt") >= 2)
        row = stats.agg(F.count_if(not_star).alias("open"), F.sum("n_gt").alias("n"), F.max("n_lt").alias("most_lt"),
                        F.max("n_gt").alias("most_gt")).first()
        if row["open"] == 0:
            break
        # The large-star output is read three times by the small star. Written, it has as many
        # partitions as its rows need; cached, it keeps every shuffle partition. A node has no more
        # smaller neighbours after the large star than before it.
        limit = hub_limit(row["n"])
        hub_up, hub_down = (limit if row[c] >= limit else None for c in ("most_gt", "most_lt"))
        large = materialize(_large_star(e, stats, hub_up))
        e = materialize(_small_star(large, _smaller(large), hub_down))
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    # Star forest: every leaf has exactly one edge, to its component's minimum;
    # centres never appear as ``hi``. So the converged edge set is the labelling.
    label = e.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return (ids.join(label, "id", "left")
               .select("id", F.coalesce(F.col("component"), F.col("id")).alias("component")))


def merge_components(labels: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst",
                     max_rounds: int = DEFAULT_MAX_ROUNDS) -> DataFrame:
    """Components after adding ``edges`` to an existing labelling ``[id, component]``.

    Equal to ``connected_components(nodes, old_edges + edges)`` when
    ``labels`` is a min-id labelling, but the iteration runs on the
    *component graph* (one node per existing component, one edge per new
    link between components), which is far smaller than the device graph.
    Component ids are minimum member ids, so the minimum over merged
    components is the minimum member id of the union.
    """
    lab = labels.select("id", "component")
    e = materialize(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a") != F.col("b")))
    ends = materialize(_endpoints(e, lab.withColumnRenamed("id", "u"), "a", "b").where("component is not null"))
    row = ends.agg(F.sum("degree").alias("n"), F.max("degree").alias("most")).first()
    limit = hub_limit(row["n"] or 0)
    limit = limit if (row["most"] or 0) >= limit else None
    for end, c in (("a", "src"), ("b", "dst")):
        at = ends.select(F.col("u").alias(end), "degree", F.col("component").alias(c))
        e = materialize(at_nodes(e, end, at, limit))
    links = e.where("src != dst").select("src", "dst")
    comps = lab.select(F.col("component").alias("id")).distinct()
    merged = connected_components(comps, links, max_rounds=max_rounds)
    return (lab.join(merged.select(F.col("id").alias("component"), F.col("component").alias("_m")), "component")
               .select("id", F.col("_m").alias("component")))


def graph_counts(nodes: DataFrame, truth: DataFrame, labels: DataFrame,
                 edge_sets: dict[str, DataFrame]) -> DataFrame:
    """Long table of graph sizes (I12): ``[metric, value]``.

    nodes ``[id]``, truth ``[id, person]``, labels ``[id, component]``; one
    row per named edge set. Each count is its own small aggregate, unioned
    into one result (no driver round-trips).
    """
    parts = [
        nodes.agg(F.count(F.lit(1)).alias("value")).select(F.lit("devices_in_graph").alias("metric"), "value"),
        truth.agg(F.count_distinct("person").alias("value")).select(F.lit("true_persons").alias("metric"), "value"),
        labels.agg(F.count_distinct("component").alias("value"))
              .select(F.lit("resolved_entities").alias("metric"), "value"),
    ]
    for name, e in edge_sets.items():
        parts.append(e.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
