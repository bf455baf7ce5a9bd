import pytest

from cohort.operators import blocking, consent
from cohort.operators.evaluation import pairwise_prf
from cohort.plans.catalog import QUERIES
from conftest import SF001


def _signals(spark, rows):
    return spark.createDataFrame(rows, "device_id long, signal_type string, signal_value string")


def test_block_cap_is_inclusive(spark):
    rows = [(i, "ip", "fifty") for i in range(50)] + [(100 + i, "ip", "fiftyone") for i in range(51)]
    pairs = blocking.ip_candidates(_signals(spark, rows))
    assert pairs.count() == 50 * 49 // 2
    sizes = {r["signal_value"]: (r["n_devices"], r["usable"]) for r in blocking.block_sizes(_signals(spark, rows)).collect()}
    assert sizes == {"fifty": (50, True), "fiftyone": (51, False)}


def test_same_device_twice_counts_once(spark):
    rows = [(1, "hashed_email", "e"), (1, "hashed_email", "e"), (2, "hashed_email", "e")]
    assert [tuple(r) for r in blocking.deterministic_edges(_signals(spark, rows)).collect()] == [(1, 2)]


def test_types_are_kept_apart_unless_merged(spark):
    rows = [(1, "hashed_email", "v"), (2, "maid", "v")]
    s = _signals(spark, rows)
    assert blocking.deterministic_edges(s).count() == 0
    assert blocking.self_pairs(s, ["hashed_email", "maid"], merge_types=True).count() == 1


def test_all_singletons_prf_is_zero(spark):
    assign = spark.createDataFrame([(i, i) for i in range(4)], "id long, component long")
    truth = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2)], "id long, person long")
    r = pairwise_prf(assign, truth).first()
    assert (r["tp"], r["predicted_pairs"], r["true_pairs"]) == (0, 0, 2)
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_empty_persons_report_is_zeros(spark):
    p = spark.createDataFrame([], "person_id long, region string, gdpr_consent boolean, ccpa_opt_out boolean")
    r = consent.consent_report(p).first()
    assert tuple(r) == (0, 0, 0.0, 0, 0)


def test_null_consent_is_not_allowed(spark):
    p = spark.createDataFrame([(1, "EU", None, False), (2, "US", True, None), (3, "US", True, False)],
                              "person_id long, region string, gdpr_consent boolean, ccpa_opt_out boolean")
    assert [r[0] for r in consent.allowed_person_ids(p).collect()] == [3]


@pytest.mark.parametrize("name,expected", [("det_edges", 1696), ("ip_candidates", 9256),
                                           ("new_candidates", 8236), ("gate_devices", 1368)])
def test_golden_counts_sf0001(spark, name, expected):
    assert QUERIES[name](spark, SF001).count() == expected


def test_golden_prf_sf0001(spark):
    r = QUERIES["pairwise_prf"](spark, SF001).first()
    assert (r["tp"], r["predicted_pairs"], r["true_pairs"]) == (1696, 1696, 6827)
    assert round(r["recall"], 4) == 0.2484


def test_typed_pairs_equal_separate_operators(spark):
    from cohort.plans.catalog import _gated
    g = _gated(spark, SF001)
    tp = blocking.typed_pairs(g.signals)
    det = {tuple(r) for r in tp.where("deterministic").select("src", "dst").collect()}
    new = {tuple(r) for r in tp.where("probabilistic and not deterministic").select("src", "dst").collect()}
    assert det == {tuple(r) for r in blocking.deterministic_edges(g.signals).collect()}
    assert new == {tuple(r) for r in blocking.new_candidates(blocking.ip_candidates(g.signals),
                                                             blocking.deterministic_edges(g.signals)).collect()}


def test_typed_pairs_merge_types_matches_group_pairing(spark):
    rows = [(1, "hashed_email", "v"), (2, "maid", "v"), (3, "ip", "v"), (4, "ip", "v"), (5, "ip", "w")]
    s = _signals(spark, rows)
    tp = blocking.typed_pairs(s, merge_types=True)
    det = {tuple(r) for r in tp.where("deterministic").select("src", "dst").collect()}
    prob = {tuple(r) for r in tp.where("probabilistic").select("src", "dst").collect()}
    assert det == {tuple(r) for r in blocking.self_pairs(s, blocking.DETERMINISTIC_TYPES, merge_types=True).collect()}
    assert prob == {tuple(r) for r in blocking.self_pairs(s, blocking.PROBABILISTIC_TYPES, merge_types=True).collect()}
    assert det == {(1, 2)} and prob == {(3, 4)}
