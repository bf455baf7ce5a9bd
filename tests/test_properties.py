"""Property tests against brute force on small random inputs (hypothesis)."""
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohort.operators import evaluation

labels = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), min_size=2, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _brute_prf(pairs):
    idx = range(len(pairs))
    same = lambda i, j, k: pairs[i][k] == pairs[j][k]
    tp = sum(same(i, j, 0) and same(i, j, 1) for i, j in itertools.combinations(idx, 2))
    pred = sum(same(i, j, 0) for i, j in itertools.combinations(idx, 2))
    real = sum(same(i, j, 1) for i, j in itertools.combinations(idx, 2))
    return tp, pred, real


@SETTINGS
@given(labels, st.integers(1, 5))
def test_pairwise_prf_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate(rows)], "id long, component long, person long")
    r = evaluation.pairwise_prf(df.select("id", "component").repartition(parts), df.select("id", "person")).first()
    assert (r.tp, r.predicted_pairs, r.true_pairs) == _brute_prf(rows)


@SETTINGS
@given(labels)
def test_ari_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate(rows)], "id long, a long, b long")
    n = len(rows)
    s, a, b = _brute_prf(rows)
    total = n * (n - 1) / 2
    e = a * b / total
    den = (a + b) / 2 - e
    want = 1.0 if den == 0 else (s - e) / den
    got = evaluation.adjusted_rand(df, df, "id", "a", "b").first().ari
    assert got == pytest.approx(round(want, 6), abs=1e-6)


scores = st.lists(st.tuples(st.integers(0, 6).map(lambda x: x / 6), st.integers(0, 1)), min_size=2, max_size=30)


@SETTINGS
@given(scores, st.integers(1, 4))
def test_auc_matches_brute_force(spark, rows, parts):
    pos = [s for s, l in rows if l == 1]
    neg = [s for s, l in rows if l == 0]
    df = spark.createDataFrame([(float(s), float(l)) for s, l in rows], "score double, label double").repartition(parts)
    got = evaluation.auc(df).first().auc
    if not pos or not neg:
        assert got is None
    else:
        want = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
        assert got == pytest.approx(want, abs=1e-6)


@SETTINGS
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.floats(0.05, 0.9))
def test_top_fraction_matches_sorted_prefix(spark, vals, frac):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, score double")
    got = sorted(r.id for r in evaluation.top_fraction(df, frac).collect())
    k = max(1, int(len(vals) * frac))
    want = sorted(i for i, _ in sorted(enumerate(vals), key=lambda t: (-t[1], t[0]))[:k])
    assert got == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=40))
def test_components_match_union_find_with_string_ids(spark, edges):
    from cohort.operators.graph import connected_components
    parent = list(range(30))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    name = lambda i: f"d{i:02d}"  # noqa: E731  (zero-padded: string order = numeric order)
    want = {name(i): name(min(j for j in range(30) if find(j) == find(i))) for i in range(30)}
    nodes = spark.createDataFrame([(name(i),) for i in range(30)], "id string")
    e = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "src string, dst string")
    assert {r.id: r.component for r in connected_components(nodes, e).collect()} == want


def test_grid_credible_interval_matches_numeric_quantiles(spark):
    import numpy as np

    from cohort.operators import campaign
    a, b = 21.0, 181.0                                    # 20 successes, 180 failures, Beta(1,1) prior
    x = np.linspace(0, 1, 2_000_001)[1:-1]
    logf = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    cdf = np.cumsum(np.exp(logf - logf.max()))
    cdf /= cdf[-1]
    lo, hi = x[np.searchsorted(cdf, 0.025)], x[np.searchsorted(cdf, 0.975)]
    counts = spark.createDataFrame([("t", "a", 20, 180), ("t", "b", 5, 195)],
                                   "test string, arm string, successes long, failures long")
    g = {r.arm: r for r in campaign.grid_posterior(campaign.beta_posterior(counts)).collect()}["a"]
    step = 1e-3
    assert abs(g.ci_low - lo) < step and abs(g.ci_high - hi) < step


def test_grid_has_no_scale_limit_and_ignores_added_arms(spark):
    """Huge counts beside an empty arm: intervals and duels of the others stay as they are."""
    from cohort.operators import campaign
    n = 10 ** 12
    rows = [("t", "a", n // 2, n // 2), ("t", "b", n // 2 + 10 ** 6, n // 2 - 10 ** 6)]
    schema = "test string, arm string, successes long, failures long"

    def solve(rows):
        post = campaign.beta_posterior(spark.createDataFrame(rows, schema))
        return ({r.arm: r for r in campaign.grid_posterior(post).collect()},
                {r.arm: r.p_beats for r in campaign.beats_control(post).collect()})

    two, duel2 = solve(rows)
    three, duel3 = solve(rows + [("t", "c", 0, 0)])
    sd = 0.5 / n ** 0.5
    for arm, mid in (("a", 0.5), ("b", 0.5 + 1e-6)):
        for g in (two, three):
            assert abs(g[arm].ci_low - (mid - 1.959964 * sd)) < 0.01 * sd
            assert abs(g[arm].ci_high - (mid + 1.959964 * sd)) < 0.01 * sd
    from statistics import NormalDist
    want = NormalDist().cdf(1e-6 / (sd * 2 ** 0.5))
    assert abs(two["b"].p_best - want) < 1e-3 and abs(duel2["b"] - want) < 1e-3 and duel3["b"] == duel2["b"]
    # Arm c wins with about one half; the rest is shared as before.
    assert abs(three["b"].p_best / (1 - three["c"].p_best) - want) < 5e-3


def test_replay_with_an_arm_that_has_only_null_rewards(spark):
    from cohort.operators import campaign
    rows = [("t", 1, "a", 1), ("t", 1, "b", None), ("t", 2, "a", 0), ("t", 2, "b", None)]
    out = campaign.bandit_replay(spark.createDataFrame(rows, "test string, batch int, arm string, reward int")).collect()
    assert [r.n for r in sorted(out, key=lambda r: r.batch)] == [1, 1]
