"""Near-duplicates: fast similarity sketching, banding, exact verification, components.

Sketch (Dahlgaard, Knudsen, Thorup, FOCS 2017): ``T`` bins; in round i every shingle is
hashed to one bin with value i + v, v in [0, 1), and a bin keeps its least value. Rounds
go on until every bin is filled; from round T on, every shingle goes to bin i - T, so 2T
rounds always suffice. Coordinates then agree with probability J, with the concentration
of independent samples, for short texts too, at O(n + T log T) expected hashes.

``BANDS`` bands of ``ROWS`` coordinates make candidates: a pair at similarity 0.8 shares
no band with probability (1 - 0.8**5)**40 = 1.3e-7, one above it with less. Every link is
confirmed on the full shingle sets.

Shape of the job. Texts with equal words form one class, so exact copies never meet as pairs.
In each bucket of classes every member is compared with one hub, the member with the most
bucket mates: in a group of near copies that is the text they come from. What
is linked so far is contracted to components. Only pairs *across* components remain, and both
sides of each have been compared with a common hub h. Write D(x) for the shingles in which x and h
differ. Then J(x, y) >= t needs |D(x) & D(y)| >= (|D(x)| + |D(y)| - d (|x| + |y|)) / 2 with
d = (1 - t) / (1 + t), so x and y must share a shingle among the first few of D(x) and D(y) in a
common order (prefix filtering, rare shingles first), early enough for the rest to hold that overlap. A
join on (hub, shingle) finds these pairs; no other pair can be linked. So nothing that could change the
result is left out, no bucket has a cap, and thousands of near copies do not meet pair by pair.

Full sets are rebuilt for compared classes only: a fixed-size bitmap of their ids
(``BITMAP_BITS`` bits, 4 MB) is broadcast and lets the second scan skip other texts.
Its false positives only cost time.

Defined results: null texts and texts without words have no shingles and link with
nothing; a text with fewer than ``SHINGLE`` words is one shingle; rows that repeat a
doc_id count as one node that has all their links; a row without doc_id is never linked,
has no component and is kept.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import bit_of, bitmap_bits, groups, id_bitmap, map_arrow, pick, written
from cohort.operators.graph import connected_components

SHINGLE = 4
BANDS, ROWS = 40, 5
BATCH_CHARS = 2 << 20
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered (``bytes`` methods touch ASCII only)."""
    return text.encode().lower().split() if text else []


def shingles(tokens: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    import xxhash
    if not tokens:
        return np.empty(0, _U)
    k = min(width, len(tokens))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), _U, len(tokens))
    n = len(h) - k + 1
    out = np.full(n, k, _U)
    for i in range(k):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates per set; rows of empty sets stay at the maximum."""
    out = np.full((len(sets), bins), np.iinfo(_U).max, _U)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], np.int64)
    active = np.flatnonzero(sizes)
    for i in range(2 * bins):
        if not len(active):
            break
        x = np.concatenate([sets[d] for d in active])
        row = np.repeat(active * bins, sizes[active])
        h = _mix(x + _U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        # Top bits choose the bin, a second mix gives the value; the round leads.
        at = (((h >> _U(40)) * _U(bins)) >> _U(24)).astype(np.int64) if i < bins else i - bins
        value = (_U(i) << _U(52)) | (_mix(h + _U(0x632BE59BD9B4E019)) >> _U(12))
        np.minimum.at(flat, row + at, value)
        active = active[(out[active] == np.iinfo(_U).max).any(axis=1)]
    return out


def bands(sketch: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """Bucket ids, one per band; the band's number is part of the id."""
    parts = sketch.reshape(len(sketch), n_bands, rows)
    h = np.broadcast_to(np.arange(n_bands, dtype=_U) + _U(1), (len(sketch), n_bands)).copy()
    for r in range(rows):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return h.view(np.int64)


def _key(tokens: list[bytes]) -> bytes:
    """Identity of a word sequence."""
    return hashlib.blake2b(b" ".join(tokens), digest_size=16).digest()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """(rows, their words) in groups of about BATCH_CHARS of text."""
    for b in batches:
        texts = b.column(1).to_pylist()
        for start, n in groups(texts, BATCH_CHARS):
            yield b.slice(start, n), [words(t) for t in texts[start:start + n]]


def sketch_table(docs: DataFrame, width: int, n_bands: int, rows: int) -> DataFrame:
    """``[doc_id, n_shingles, key, bands]``; ``key`` identifies the word sequence, null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, tokens in _words(batches):
            keys = [_key(w) if w else None for w in tokens]
            sets = [shingles(w, width) for w in tokens]
            buckets = bands(sketches(sets, n_bands * rows), n_bands, rows)
            lists = pa.ListArray.from_arrays(np.arange(0, buckets.size + 1, n_bands, dtype=np.int32),
                                             pa.array(buckets.reshape(-1)))
            yield pa.record_batch({"doc_id": b.column(0), "n_shingles": pa.array(map(len, sets), pa.int64()),
                                   "key": pa.array(keys, pa.binary()), "bands": lists})

    return map_arrow(docs, run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, key binary, bands array<long>")


def compared_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``[key, shingles]`` of at least the texts whose id is in ``ids[id]``; other texts are skipped unread."""
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids.select(bit_of("id").alias("bit"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap_bits(shared.value)
        for b in batches:
            for _, tokens in _words(iter([b.filter(pa.array(bits[b.column(2).to_numpy()]))])):
                tokens = [w for w in tokens if w]
                found = [shingles(w, width).view(np.int64) for w in tokens]
                yield pa.record_batch({"key": pa.array(map(_key, tokens), pa.binary()),
                                       "shingles": pa.array(found, pa.list_(pa.int64()))})

    src = docs.where("doc_id is not null and text is not null").withColumn("bit", bit_of("doc_id"))
    return map_arrow(src, run, "key binary, shingles array<long>").dropDuplicates(["key"])


def _linked(n: F.Column, size: F.Column, percent: int) -> F.Column:
    """Whether ``n`` common shingles of sets of ``size`` in all make the similarity."""
    return (100 + percent) * n >= percent * size


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs[a, b, ...]`` with ``n``, the shingles their sets share."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.select(*pairs.columns, F.size(F.array_intersect("sa", "sb")).cast("long").alias("n"))


def across(compared: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``[a, b]``: every pair of classes that may be linked, though two components hold them.

    ``compared[a, b, na, nb, n]`` are the hub comparisons (``a`` is the hub).
    """
    d = (100.0 - percent) / (100.0 + percent)
    member = compared.join(labels.select(F.col("id").alias("b"), "component"), "b", "left").select(
        "a", "b", "na", "nb", F.coalesce("component", "b").alias("label"),
        (F.col("na") + F.col("nb") - 2 * F.col("n")).alias("size"),
        (~_linked(F.col("n"), F.col("na") + F.col("nb"), percent)).alias("far"))
    mixed = written(member.groupBy("a").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                          .where("lo <> hi").select("a"), "mixed")
    # A member equal to its hub has been compared with all of them.
    member = written(member.where("size > 0").join(mixed, "a").withColumn("row", F.monotonically_increasing_id()),
                     "members")
    hub = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    own = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    differing = F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb"))
    # A mark is a differing shingle under its hub; equal hashes of others only add candidates.
    marks = written(member.select("row", "a", "b").join(hub, "a").join(own, "b")
                          .select("row", "a", F.explode(differing).alias("mark"))
                          .select("row", F.xxhash64("a", "mark").alias("mark")), "marks")
    counts = written(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("uses")), "uses")
    # The common order: rare marks first. Marks of one member take their place but find nobody.
    ordered = (marks.join(counts, "mark").groupBy("row")
                    .agg(F.array_sort(F.collect_list(F.struct("uses", "mark"))).alias("marks")))
    # Least overlap with a far member, for all; least overlap with any member, for far ones.
    least = F.greatest(F.floor((F.col("size") + d * (F.col("na") - F.col("nb"))) / 2 - 1e-6) + 1, F.lit(1))
    most = F.lit(1.0 + 100.0 / percent)  # a linked partner has at most 100 / percent times the shingles
    least_far = F.greatest(F.ceil(F.col("size") - d * most * F.col("nb") - 1e-6), F.lit(1))
    indexed = F.greatest(F.col("size") - least + 1, F.lit(0))
    first = F.greatest(indexed, F.when(F.col("far"), F.col("size") - least_far + 1).otherwise(0))
    prefixes = member.join(ordered, "row").select(
        "b", "nb", "label", "size", "far", indexed.alias("indexed"),
        F.posexplode(F.slice("marks", F.lit(1), first.cast("int"))).alias("at", "m"))
    prefixes = written(prefixes.where("m.uses > 1").withColumn("mark", F.col("m.mark")).drop("m"), "prefixes")
    index = prefixes.where("at < indexed").select(
        "mark", *[F.col(c).alias(f"y_{c}") for c in ("b", "nb", "label", "size", "at")])
    probe = prefixes.where("far").select("mark", "b", "nb", "label", "size", "at")
    room = d * (F.col("nb") + F.col("y_nb"))
    # At the first common mark all of the overlap is still to come: the shorter rest must hold it.
    rest = F.least(F.col("size") - F.col("at"), F.col("y_size") - F.col("y_at"))
    return (probe.join(index, "mark").where(F.col("label") != F.col("y_label"))
                 .where(2 * rest + room + 1e-6 >= F.col("size") + F.col("y_size"))
                 .where(100 * F.least("nb", "y_nb") >= percent * F.greatest("nb", "y_nb"))
                 .select(F.least("b", "y_b").alias("a"), F.greatest("b", "y_b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    percent: int = 80, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``[doc_id, n_shingles, component_id, kept]``, one row per input row."""
    src = pick(docs, doc_id=id_col, text=text_col)
    sketch = written(sketch_table(src, width, n_bands, rows), "sketches")
    linked = sketch.where("doc_id is not null and key is not null")
    # Written, like all that is joined below, so that joins shuffle both sides and a hot key can be split.
    classes = written(linked.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                                                F.first("bands").alias("bands")), "classes")
    buckets = classes.select("key", "n", F.explode("bands").alias("bucket"))
    crowded = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1"), "crowded")
    mates = written(buckets.join(crowded, "bucket"), "mates")
    fame = written(mates.groupBy("key").agg(F.sum("mates").alias("fame")), "fame")
    hubs = written(mates.join(fame, "key").groupBy("bucket").agg(F.min(F.struct(
        (-F.col("fame")).alias("fame"), F.col("key").alias("a"), F.col("n").alias("na"))).alias("h"))
        .select("bucket", "h.a", "h.na"), "hubs")
    pairs = written(mates.join(hubs, "bucket").where("key <> a")
                         .select("a", F.col("key").alias("b"), "na", F.col("n").alias("nb")).distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(classes.select("key", "rep"), "key")
    sets = written(compared_sets(src, ids.select(F.col("rep").alias("id")), width), "sets")

    # Rows that repeat a doc_id with other words tie their classes together.
    repeated = written(linked.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
                             .where("lo <> hi").select("doc_id", F.col("lo").alias("a")), "repeated")
    tied = linked.select("doc_id", F.col("key").alias("b")).join(repeated, "doc_id").where("a <> b").select("a", "b")
    compared = written(overlaps(pairs, sets), "compared")
    links = written(compared.where(_linked(F.col("n"), F.col("na") + F.col("nb"), percent)).select("a", "b")
                            .unionByName(tied).distinct(), "links")
    labels = _components(links)
    more = written(across(compared, labels, sets, percent), "pairs")
    sized = more.join(classes.select(F.col("key").alias("a"), F.col("n").alias("na")), "a").join(
        classes.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b")
    found = written(overlaps(sized, sets).where(_linked(F.col("n"), F.col("na") + F.col("nb"), percent))
                                         .select("a", "b"), "links")
    if not found.isEmpty():
        labels = _components(links.unionByName(found))

    # Class -> component -> its least doc_id, then row -> class: joins that can be split.
    rooted = written(classes.select("key", "rep").join(labels, classes["key"] == labels["id"], "left")
                            .select("key", "rep", F.coalesce("component", "key").alias("component")), "rooted")
    least = written(rooted.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    roots = written(rooted.join(least, "component").select("key", "component_id"), "roots")
    out = sketch.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    done = out.where("key is not null").join(roots, "key").select("doc_id", "n_shingles", "component_id")
    alone = out.where("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return done.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _components(links: DataFrame) -> DataFrame:
    nodes = links.select(F.explode(F.array("a", "b")).alias("id"))
    return written(connected_components(nodes, links, src="a", dst="b"), "components")
