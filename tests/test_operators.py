"""Direct tests of operators otherwise covered only through queries."""
import pytest
from pyspark.sql import functions as F

from cohort.functions.expressions import pseudonymize
from cohort.operators import affinity, campaign, lookalike, segments
from cohort.sources.contracts import contract_check


def test_segment_sizes_include_empty_clusters(spark):
    a = spark.createDataFrame([(1, 0), (2, 0), (3, 2)], "person_id long, cluster int")
    assert [tuple(r) for r in segments.segment_sizes(a, 4).collect()] == [(0, 2), (1, 0), (2, 1), (3, 0)]


def test_standardize_zero_variance_maps_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id long, a double, b double")
    rows = {r.id: (r.a, r.b) for r in affinity.standardize(df, ["a", "b"], keep=["id"]).collect()}
    s = 2 ** 0.5
    assert rows[1] == (0.0, pytest.approx(-1 / s)) and rows[2] == (0.0, pytest.approx(1 / s))


def test_affinity_wide_pivot_fills_zero_and_weights_clicks(spark):
    ev = spark.createDataFrame([(1, "cat_00", 1), (1, "cat_00", 0), (1, "cat_05", 0)],
                               "person_id long, content_cat string, click int")
    r = affinity.spread(affinity.cells(ev, "person_id"), "person_id").first()
    assert (r.cat_00, r.cat_05, r.cat_11) == (5.0, 1.0, 0.0)


def test_eb_prior_falls_back_to_uniform(spark):
    c = spark.createDataFrame([("t", "a", 5, 5, 10), ("t", "b", 5, 5, 10)],
                              "test string, arm string, successes long, failures long, trials long")
    r = campaign.eb_prior(c).first()
    assert (r.prior_alpha, r.prior_beta) == (1.0, 1.0)


def test_replay_first_batch_is_uniform(spark):
    rows = [("t", d, a, int(i % 3 == 0)) for d in ("2024-01-01", "2024-01-02") for a in ("x", "y", "z")
            for i in range(6)]
    s = spark.createDataFrame(rows, "test string, batch string, arm string, reward int")
    r = {x.batch: x for x in campaign.bandit_replay(s).collect()}
    assert r["2024-01-01"].best_share == pytest.approx(1 / 3, abs=1e-6)
    assert r["2024-01-02"].cum_uniform_regret == pytest.approx(0.0, abs=1e-9)


def test_int_ids_builds_dense_dictionary_for_large_ids(spark):
    big = 2 ** 40
    df = spark.createDataFrame([(big + 7, "a"), (big + 3, "b"), (big + 7, "c")], "person_id long, x string")
    dense, dictionary = lookalike.int_ids(df)
    assert dictionary is not None
    assert sorted(r.person_id for r in dense.collect()) == [0, 1, 1]
    assert {(r.person_id, r._iid) for r in dictionary.collect()} == {(big + 3, 0), (big + 7, 1)}


def test_pseudonym_salt_changes_value(spark):
    df = spark.createDataFrame([(1,)], "k long")
    r = df.select(pseudonymize("k").alias("a"), pseudonymize("k", salt="s").alias("b")).first()
    assert len(r.a) == 16 and r.a != r.b


def test_contract_check_flags_schema_and_key(spark):
    bad = spark.createDataFrame([(1, 2, "x"), (1, 3, "y")], "device_id long, person_id long, device_type string")
    r = contract_check({"devices": bad}).first()
    assert r.schema_ok and not r.key_unique
    drift = bad.withColumn("device_id", F.col("device_id").cast("string"))
    assert not contract_check({"devices": drift}).first().schema_ok


def test_item_dictionary_is_dense_and_ordered(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "content_cat string")
    d = {r.content_cat: r.item for r in lookalike.item_dictionary(df).collect()}
    assert d == {"a": 0, "b": 1, "c": 2}
    inter = spark.createDataFrame([(1, "c", 4)], "person_id long, content_cat string, weight long")
    assert [tuple(r) for r in lookalike.ratings_from_dictionary(inter, lookalike.item_dictionary(df)).collect()] \
        == [(1, 2, 4.0)]


def test_person_affinity_keep_all_adds_zero_rows(spark):
    devices = spark.createDataFrame([(1, 10), (2, 11)], "device_id long, person_id long")
    events = spark.createDataFrame([(1, "cat_00", 0)], "device_id long, content_cat string, click int")
    assert affinity.person_affinity(events, devices).count() == 1
    rows = {r.person_id: r.cat_00 for r in affinity.person_affinity(events, devices, keep_all=True).collect()}
    assert rows == {10: 1.0, 11: 0.0}


def test_per_type_block_cap(spark):
    from cohort.operators import blocking
    rows = [(i, "ip", "v") for i in range(4)] + [(10 + i, "maid", "w") for i in range(4)]
    s = spark.createDataFrame(rows, "device_id long, signal_type string, signal_value string")
    pairs = blocking.self_pairs(s, ["ip", "maid"], max_block={"ip": 3, "*": 50})
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for a in range(10, 14) for b in range(10, 14) if a < b}
    tp = blocking.typed_pairs(s, det_types=["maid"], prob_types=["ip"], max_block={"maid": 3})
    assert tp.where("deterministic").count() == 0 and tp.where("probabilistic").count() == 6


def test_unknown_categories_count_and_zero_norms_are_null(spark):
    ev = spark.createDataFrame([(1, "cat_00", 0), (1, "cat_99", 0), (2, "cat_99", 0)],
                               "device_id long, content_cat string, click int")
    u = {r.device_id: r.u for r in affinity.unit_vectors(ev).collect()}
    assert affinity.categories(ev) == ["cat_00", "cat_99"]
    assert u[1] == pytest.approx([2 ** -0.5] * 2) and u[2] == [0.0, 1.0]
    long = {(r.device_id, r.content_cat): r.u for r in affinity.unit_vectors_long(ev).collect()}
    assert long == pytest.approx({(1, "cat_00"): 2 ** -0.5, (1, "cat_99"): 2 ** -0.5, (2, "cat_99"): 1.0})
    # Positions that leave a device's categories out give null cells, not an error.
    only = {r.device_id: r.u for r in affinity.unit_vectors(ev, cats=["cat_00"]).collect()}
    assert only[1] == [1.0] and only[2] == [None]


def test_pair_features_stay_in_generated_code(spark):
    ev = spark.createDataFrame([(i, f"cat_{i % 3:02d}", 1) for i in range(6)], "device_id long, content_cat string, click int")
    dev = spark.createDataFrame([(i, i // 2, "tv") for i in range(6)], "device_id long, person_id long, device_type string")
    pairs = spark.createDataFrame([(0, 3), (0, 1)], "src long, dst long")
    out = affinity.pair_features(pairs, affinity.device_profiles(dev, ev), len(affinity.categories(ev)))
    assert "aggregate(" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.src, r.dst): (r.cosine, r.same_type, r.label) for r in out.collect()} == {(0, 3): (1.0, 1.0, 0.0), (0, 1): (0.0, 1.0, 1.0)}


def test_pseudonym_of_a_null_part_is_null(spark):
    from cohort.functions.expressions import choose2, pseudonymize
    df = spark.createDataFrame([(None, "a"), ("a", "b")], "x string, y string")
    assert [r[0] is None for r in df.select(pseudonymize("x", "y")).collect()] == [True, False]
    n = spark.createDataFrame([(4_000_000_000,), (3_999_999_999,), (0,), (1,)], "n long").select(choose2("n")).collect()
    assert [r[0] for r in n] == [k * (k - 1) // 2 for k in (4_000_000_000, 3_999_999_999, 0, 1)]



def test_sparse_cosines_equal_brute_force_for_any_number_of_categories(spark, monkeypatch):
    import random
    rng = random.Random(3)
    rows = [(d, f"c{rng.randrange(5000 if d % 2 else 40):04d}", rng.randrange(2)) for d in range(30) for _ in range(400)]
    rows += [(100, f"c{i:05d}", 1) for i in range(5000)] + [(101, None, 1)]
    ev = spark.createDataFrame(rows, "device_id long, content_cat string, click int")
    ids = [*range(30), 100, 101, 102]
    dev = spark.createDataFrame([(i, i // 2, "tv") for i in ids], "device_id long, person_id long, device_type string")
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "src long, dst long")
    assert affinity.categories(ev) is None
    profiles = affinity.device_profiles(dev, ev)
    weight = {}
    for d, c, k in rows:
        if c is not None:
            weight.setdefault(d, {}).setdefault(c, 0)
            weight[d][c] += 3 * k + 1
    norm = {d: sum(x * x for x in w.values()) ** 0.5 for d, w in weight.items()}
    want = {(a, b): sum(weight[a][c] * weight[b].get(c, 0) for c in weight[a]) / norm[a] / norm[b]
            if a in weight and b in weight else 0.0 for a in ids for b in ids if a < b}
    assert {(r.src, r.dst): r.cosine for r in affinity.pair_features(pairs, profiles).collect()} == pytest.approx(want)


def test_sparse_and_positional_resolutions_agree(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cohort.plans import identity
    from cohort.plans.catalog import _gated
    from conftest import SF001
    g = _gated(spark, SF001)
    many = g.all_events.withColumn("content_cat", F.concat_ws("_", "content_cat", F.pmod(F.xxhash64("device_id"), F.lit(500))))
    assert affinity.categories(many) is None and many.select("content_cat").distinct().count() > 400
    same = identity.Gated(g.devices, g.signals, g.events, many)
    dense = {(r.src, r.dst): r.cosine for r in identity.candidate_features(g).collect()}
    wide = {(r.src, r.dst): r.cosine for r in identity.candidate_features(same).collect()}
    assert dense.keys() == wide.keys() and len(identity.fixed_resolution(same)) == 3
    monkeypatch.setattr(affinity, "MAX_POSITIONS", 3)
    sparse = {(r.src, r.dst): r.cosine for r in identity.candidate_features(g).collect()}
    assert sparse == pytest.approx(dense)
