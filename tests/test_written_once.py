"""Tables that several steps read are joined and summed once, with the rows of the separate ways."""
from collections import Counter

from pyspark.sql import functions as F

from cohort.operators import affinity, blocking, logistic
from cohort.plans import catalog, identity, models, segmentation

SF001 = "/root/testdata/sf0.001"


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _events(spark):
    # A device without known clicks in one category, repeated devices, a null category and a null device.
    rows = [(1, "cat_00", 1), (1, "cat_00", None), (1, "cat_01", None), (2, "cat_00", 0), (2, "cat_00", 1),
            (3, "cat_01", 1), (3, None, 1), (4, "cat_02", 0), (None, "cat_00", 1)]
    devices = [(1, 10), (2, 10), (2, 10), (3, 11), (4, None), (5, 12)]
    return (spark.createDataFrame(rows, "device_id long, content_cat string, click int"),
            spark.createDataFrame(devices, "device_id long, person_id long"))


def test_sums_give_the_rows_of_the_separate_ways(spark):
    events, devices = _events(spark)
    sums = affinity.person_sums(events, devices)
    assert _rows(affinity.affinity_of(sums)) == _rows(affinity.person_affinity(events, devices))
    assert _rows(affinity.interactions_of(sums)) == _rows(affinity.interactions(events, devices))
    wide = {r.person_id: (r.cat_00, r.cat_01) for r in affinity.affinity_of(sums).collect()}
    # Person 10: device 1 weighs 3 + 2 and nothing in cat_01, device 2 weighs 3 + 2 and counts twice.
    assert wide[10] == (15.0, 0.0)


def test_lookalike_inputs_are_written(spark):
    inter, users, _ = catalog._lookalike_inputs(spark, SF001)
    assert "Join" not in _plan(inter) and "Relation" not in _plan(users)
    g = catalog._gated(spark, SF001)
    assert _rows(inter) == _rows(affinity.interactions(g.all_events, g.devices))


def test_resolution_writes_its_signals_and_lists_given_categories(spark, monkeypatch):
    fx = catalog._fx(spark, SF001)
    listed = []
    whole = affinity.categories
    monkeypatch.setattr(affinity, "categories", lambda t: listed.append(t) or whole(t))
    g = identity.gate(fx.persons(), fx.devices(), fx.signals(), fx.events())
    sums = affinity.person_sums(g.all_events, g.devices)
    res = identity.resolve_identities(fx.persons(), fx.devices(), fx.signals(), fx.events(), activity=sums)
    assert listed == [sums]
    assert "Join" not in _plan(res.suppressed)
    plain = identity.resolve_identities(fx.persons(), fx.devices(), fx.signals(), fx.events())
    assert _rows(res.full_labels) == _rows(plain.full_labels)
    assert _rows(res.ablation) == _rows(plain.ablation)
    assert _rows(res.suppressed) == _rows(blocking.suppressed_blocks(g.signals))


def test_summary_sums_the_impressions_once(spark, monkeypatch):
    taken = []
    whole = affinity.person_cells
    monkeypatch.setattr(affinity, "person_cells", lambda *a: taken.append(a) or whole(*a))
    given = []

    def stand_in(result):
        def run(g, persons, sums=None):
            given.append(sums)
            return result
        return run

    none = spark.createDataFrame([], "metric string, value double")
    ari = spark.createDataFrame([("kmeans", 0.5)], "model string, ari double")
    monkeypatch.setattr(segmentation, "segment_people", stand_in(segmentation.Segmentation(none, 2, none, ari, none, none)))
    monkeypatch.setattr(models, "propensity_models", stand_in(models.Propensity(none, none)))
    monkeypatch.setattr(models, "als_lookalike", stand_in(models.Lookalike(none, none, none, ari.select(F.col("ari").alias("lift")))))
    monkeypatch.setattr(models, "ctr_model", lambda g: models.Ctr(none, none))
    got = {r.module for r in catalog.q_metrics_summary(spark, SF001).collect()}
    assert {"consent", "identity", "segmentation", "lookalike", "campaign"} <= got
    # The segmentation joins its own.
    assert len(taken) == 1 and given[0] is None and len(given) == 3
    assert all("Join" not in _plan(s) for s in given[1:])


def _signals(spark):
    # Repeated rows, a null device, a null value, a value of two types, and a hot value above a cap of 3.
    rows = [(1, "ip", "a"), (1, "ip", "a"), (2, "ip", "a"), (None, "ip", "a"), (2, "maid", "a"), (3, "maid", "a"),
            (3, "hashed_email", "e"), (4, "hashed_email", "e"), (5, "ip", None), (5, "cookie", "a"),
            *[(d, "ip", "hot") for d in range(10, 16)], *[(d, "maid", "m") for d in (1, 2, 3, 4)]]
    return spark.createDataFrame(rows, "device_id long, signal_type string, signal_value string")


def test_members_give_the_rows_of_the_separate_ways(spark, monkeypatch):
    s = _signals(spark)
    members = blocking.block_members(s)
    oversized = blocking.oversized_blocks(members, 3)
    assert _rows(blocking.suppressed_of(oversized)) == _rows(blocking.suppressed_blocks(s, max_block=3))
    det = members.where(F.col("block_type").isin(list(blocking.DETERMINISTIC_TYPES)))
    assert _rows(blocking.star_edges_of(det)) == _rows(blocking.star_edges(s))
    want = _rows(blocking.typed_pairs(s, max_block=3))
    assert want == Counter({(1, 2, False, True): 1, (2, 3, True, False): 1, (3, 4, True, False): 1})
    # The blocks above the cap are few enough for a broadcast, or not.
    assert _rows(blocking.typed_pairs_of(members, max_block=3, oversized=oversized)) == want
    monkeypatch.setattr(blocking, "OVERSIZED_ROWS", 0)
    assert _rows(blocking.typed_pairs_of(members, max_block=3, oversized=oversized)) == want


def test_resolution_counts_its_blocks_once_and_writes_its_labels(spark, monkeypatch):
    fx = catalog._fx(spark, SF001)
    listed = []
    whole = blocking._members
    monkeypatch.setattr(blocking, "_members", lambda *a: listed.append(a) or whole(*a))
    res = identity.resolve_identities(fx.persons(), fx.devices(), fx.signals(), fx.events())
    assert len(listed) == 1
    assert "Join" not in _plan(res.full_labels) and "Aggregate" not in _plan(res.suppressed)


def test_newton_steps_read_the_rows_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            reads.add(1)
            yield r

    rows = [(float(i % 7), float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitions(counted), "a double, label double")
    assert logistic.fit_newton(df, ["a"]).steps > 2 and reads.value == 60


def test_scores_and_factors_are_written(spark):
    g, persons = catalog._gp(spark, SF001)
    assert "UDF" not in _plan(models.ctr_model(g).scored)
    look = models.als_lookalike(g, persons)
    assert "Join" not in _plan(look.user_factors)
