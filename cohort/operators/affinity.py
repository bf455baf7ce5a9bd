"""Content-affinity features.

Behavioural weight of a (key, category) cell is ``3 * clicks + impressions``.
Events are summed per (device, category) first, so what meets the device
table afterwards is cells, not events. That join both gates (devices without
consent are not in it) and brings the owner.

Vectors over a short category list are positional: one ``array<double>`` over
the list, built in one ``groupBy``; cosines are unrolled sums over the positions,
which stay inside generated code. Beyond ``MAX_POSITIONS`` categories a device's
vector is the sparse list of its own categories, and a cosine merges two such
lists in one expression, so any number of categories works with memory by what a
device has, and no category list is collected. Both forms add up in the order
of the categories and give the same cosines.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.constants import CATS, CLICK_WEIGHT

# More categories than this are not unrolled into one vector column but kept as sparse lists.
MAX_POSITIONS = 64


def weight_expr(clicks, impressions) -> F.Column:
    return (CLICK_WEIGHT * clicks + impressions).cast("double")


def cells(events: DataFrame, key: str) -> DataFrame:
    """``[key, content_cat, clicks, impressions]``: engagement sums per observed cell."""
    return events.groupBy(key, "content_cat").agg(F.sum("click").alias("clicks"),
                                                  F.count(F.lit(1)).alias("impressions"))


def affinity_long(events: DataFrame, key: str) -> DataFrame:
    """``[key, content_cat, w]``: engagement weight per observed cell (A2)."""
    return cells(events, key).select(key, "content_cat", weight_expr(F.col("clicks"), F.col("impressions")).alias("w"))


def person_cells(events: DataFrame, devices: DataFrame) -> DataFrame:
    """``[person_id, content_cat, clicks, impressions]`` per device cell of the given devices.

    The inner join drops events of all other devices, so passing the consented
    devices is the gate. A person has one row per (device, category) here.
    """
    return cells(events, "device_id").join(devices.select("device_id", "person_id"), "device_id").drop("device_id")


def person_long(events: DataFrame, devices: DataFrame) -> DataFrame:
    """``[person_id, content_cat, w]`` over a person's devices."""
    total = person_cells(events, devices).groupBy("person_id", "content_cat")
    return total.agg(weight_expr(F.sum("clicks"), F.sum("impressions")).alias("w"))


def person_sums(events: DataFrame, devices: DataFrame) -> DataFrame:
    """``[person_id, content_cat, clicks, impressions, w]``: one row per person and category.

    What :func:`interactions` and :func:`person_affinity` are both derived from, to be written once where
    several are wanted. ``w`` adds up the weights of the device cells (a cell without known clicks has none).
    """
    w = weight_expr(F.col("clicks"), F.col("impressions"))
    return person_cells(events, devices).groupBy("person_id", "content_cat").agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"), F.sum(w).alias("w"))


def interactions(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Person x category implicit-feedback matrix (A3): weight and impressions, weight > 0."""
    return interactions_of(person_sums(events, devices))


def interactions_of(sums: DataFrame) -> DataFrame:
    """:func:`interactions` from :func:`person_sums`."""
    weight = weight_expr(F.col("clicks"), F.col("impressions")).cast("bigint")
    return sums.select("person_id", "content_cat", weight.alias("weight"), "impressions").where("weight > 0")


def affinity_of(sums: DataFrame, cats: Sequence[str] = CATS) -> DataFrame:
    """:func:`person_affinity` (persons with events) from :func:`person_sums`."""
    return spread(sums, "person_id", cats, F.col("w"))


def spread(sums: DataFrame, key: str, cats: Sequence[str] = CATS, w: F.Column | None = None) -> DataFrame:
    """One row per key, one weight column per category (A11, M1), from rows as :func:`cells` gives them.

    A plain aggregate of conditional sums: one shuffle, partial sums in the map tasks. ``w`` is a row's
    weight, by default that of its clicks and impressions.
    """
    w = weight_expr(F.col("clicks"), F.col("impressions")) if w is None else w
    columns = [F.coalesce(F.sum(F.when(F.col("content_cat") == c, w)), F.lit(0.0)).alias(c) for c in cats]
    return sums.groupBy(key).agg(*columns)


def person_affinity(events: DataFrame, devices: DataFrame, cats: Sequence[str] = CATS,
                    keep_all: bool = False) -> DataFrame:
    """Person x category affinity (M1). By default persons without events do
    not appear; with ``keep_all`` every owner in ``devices`` gets a row (zeros)."""
    wide = spread(person_cells(events, devices), "person_id", cats)
    if not keep_all:
        return wide
    owners = devices.select("person_id").distinct()
    return owners.join(wide, "person_id", "left").na.fill(0.0, subset=list(cats))


def categories(events: DataFrame) -> list[str] | None:
    """The observed categories in order, or None if there are more than ``MAX_POSITIONS``
    (one row over the limit is read, never the whole list)."""
    rows = (events.where(F.col("content_cat").isNotNull()).select("content_cat").distinct()
                  .limit(MAX_POSITIONS + 1).collect())
    return sorted(r["content_cat"] for r in rows) if len(rows) <= MAX_POSITIONS else None


def unit_vectors_long(events: DataFrame, key: str = "device_id") -> DataFrame:
    """Long form ``[key, content_cat, u]`` of the observed cells; any number of categories.

    The norm covers every observed category; a key without weight gives null.
    """
    w = affinity_long(events, key)
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, key).select(key, "content_cat", F.try_divide("w", "norm").alias("u"))


def unit_vectors(events: DataFrame, key: str = "device_id", cats: Sequence[str] | None = None) -> DataFrame:
    """``[key, u array<double>]``: L2-normalised weight vector over ``cats``.

    Without ``cats`` the positions are the observed categories; too many of them raise
    (use :func:`sparse_vectors`).
    """
    cats = categories(events) if cats is None else list(cats)
    if cats is None or len(cats) > MAX_POSITIONS:
        raise ValueError(f"more than {MAX_POSITIONS} content categories; use sparse_vectors")
    position = F.create_map(*[x for i, c in enumerate(cats) for x in (F.lit(c), F.lit(i))]) if cats else None
    at = position[F.col("content_cat")] if cats else F.lit(None).cast("int")
    e = events.select(key, at.alias("_at"), "click")
    sums = [weight_expr(F.sum(F.when(F.col("_at") == i, F.col("click")).otherwise(0)), F.count_if(F.col("_at") == i))
            .alias(f"_w{i}") for i in range(len(cats))]
    wide = e.groupBy(key).agg(*sums, F.count(F.lit(1)).alias("_n"))
    w = [F.col(f"_w{i}") for i in range(len(cats))]
    norm = F.sqrt(reduce(add, [x * x for x in w], F.lit(0.0)))
    normed = wide.withColumn("_norm", norm)
    u = F.array(*[F.try_divide(x, "_norm") for x in w]) if w else F.array().cast("array<double>")
    return normed.select(key, u.alias("u"))


def dot(a: str, b: str, positions: int) -> F.Column:
    """Dot product of two arrays of ``positions`` elements as one unrolled sum; 0.0 when either is null."""
    products = [F.get(F.col(a), F.lit(i)) * F.get(F.col(b), F.lit(i)) for i in range(positions)]
    return F.coalesce(reduce(add, products, F.lit(0.0)), F.lit(0.0))


def sparse_vectors(events: DataFrame, key: str = "device_id") -> DataFrame:
    """``[key, u array<struct<k, u>>]``: the L2-normalised weights of a key's own categories, in their order."""
    long = unit_vectors_long(events.where(F.col("content_cat").isNotNull()), key).where(F.col("u").isNotNull())
    cell = F.struct(F.col("content_cat").alias("k"), "u")
    return long.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("u"))


def sparse_dot(a: str, b: str) -> F.Column:
    """Dot product of two sparse vectors; 0.0 when either is null or nothing is shared.

    Both lists are laid together and sorted, so cells of the same category stand side by side: time
    n log n in the cells of the two, whatever the number of categories.
    """
    cells_of = F.array_sort(F.concat(F.col(a), F.col(b)))
    pairs = F.transform(F.array(cells_of), lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.size(c)),
        lambda x, y: F.when(x["k"] == y["k"], x["u"] * y["u"]).otherwise(0.0)))[0]
    return F.coalesce(F.aggregate(pairs, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))), F.lit(0.0))


def device_profiles(devices: DataFrame, events: DataFrame, cats: Sequence[str] | None = None) -> DataFrame:
    """``[device_id, device_type, person_id, u]``; devices without events keep ``u = null``.

    Without ``cats``, or with more than ``MAX_POSITIONS`` of them in the events, vectors are sparse as needed.
    """
    known = devices.select("device_id", "device_type", "person_id")
    cats = categories(events) if cats is None else list(cats)
    vectors = sparse_vectors(events) if cats is None else unit_vectors(events, "device_id", cats)
    return known.join(vectors, "device_id", "left")


def pair_features(cands: DataFrame, profiles: DataFrame, positions: int | None = None) -> DataFrame:
    """Candidate pairs with ``cosine``, ``same_type`` and the truth ``label``.

    Each endpoint's profile is attached as one struct, then compared. ``positions`` is the length of
    a positional ``u`` and not needed for sparse ones. ``label`` is for training and evaluation only.
    """
    sparse = "struct" in dict(profiles.dtypes)["u"]

    def attach(pairs: DataFrame, end: str) -> DataFrame:
        side = profiles.select(F.col("device_id").alias(end),
                               F.struct("device_type", "person_id", "u").alias(f"{end}_profile"))
        return pairs.join(side, end)

    both = attach(attach(cands.select("src", "dst"), "src"), "dst")
    ends = ("src_profile.u", "dst_profile.u")

    def equal(field: str) -> F.Column:
        return (F.col(f"src_profile.{field}") == F.col(f"dst_profile.{field}")).cast("double")

    return both.select("src", "dst", (sparse_dot(*ends) if sparse else dot(*ends, positions)).alias("cosine"),
                       equal("device_type").alias("same_type"), equal("person_id").alias("label"))


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Centre and scale ``cols`` by their mean and sample standard deviation (M3).

    This is an estimator fit: one aggregate returns 2 numbers per column to
    the driver (bounded by the column count, not the data); the transform
    is a plain projection. A zero-variance column maps to 0.0.
    """
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = []
    for i, c in enumerate(cols):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        if s is None or s == 0 or m is None:
            out.append(F.lit(0.0).alias(c))
        else:
            out.append(((F.col(c) - F.lit(m)) / F.lit(s)).alias(c))
    return df.select(*keep, *out)
