"""Near-duplicates against all-pairs brute force."""
import random

import numpy as np
from helpers import empty, frame, messy, messy_rows, prose  # noqa: F401

from cohort.llm import near_duplicates as nd
from cohort.llm.near_duplicates import near_duplicates


def brute(rows, percent=80):
    sets, node = [], {}
    for i, t in rows:
        w = nd.words(t)
        k = min(4, len(w))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, (i, _) in enumerate(rows):
        if i is None:
            continue
        if sets[x]:
            parent[find(x)] = find(node.setdefault(i, x))
        for y in range(x):
            n = len(sets[x] & sets[y])
            if rows[y][0] is not None and n and 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                parent[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return sorted(((i, len(sets[x]), c := None if i is None else low[find(x)], c is None or c == i)
                   for x, (i, _) in enumerate(rows)), key=str)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = f"x{rng.randrange(10 ** 6)}"
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, f"y{rng.randrange(10 ** 6)}")
    return w


def check(spark, rows):
    got = sorted(map(tuple, near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_messy_rows(messy, empty):
    got = sorted(map(tuple, near_duplicates(messy).collect()), key=str)
    assert got == brute(messy_rows())
    assert near_duplicates(empty).count() == 0


def test_groups_around_a_hub_chains_and_shared_passages(spark):
    rng = random.Random(9)
    rows, base = [], [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    rows += [" ".join(edited(rng, base, rng.randrange(0, 9))) for _ in range(150)]  # many miss 0.8 to the hub
    rows += [" ".join(base)] * 5
    for _ in range(12):  # chains: each next one is near the one before only
        w = [f"c{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(30, 90))]
        for _ in range(5):
            rows.append(" ".join(w))
            w = edited(rng, w, rng.randrange(1, 4))
    for _ in range(40):  # a common passage beside own words
        rows.append(" ".join(base[:60] + [f"p{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(5, 60))]))
    rows += ["one two three", "one two three", "one two", "ONE two\tthree"]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    check(spark, list(zip(ids, rows)))


def test_repeated_ids_tie_their_texts_together(spark):
    check(spark, [(5, prose(1, 40)), (5, prose(2, 40)), (9, prose(1, 40)), (3, prose(2, 40)), (4, prose(3, 40)), (5, None)])


def test_sketch_coordinates_agree_with_the_similarity():
    rng = np.random.default_rng(1)
    for n in (5, 40, 700):
        hits = []
        for _ in range(30):
            both = rng.integers(0, 2 ** 63, n * 10 // 9, dtype=np.uint64)
            a, b = nd.sketches([np.unique(both[:n]), np.unique(both[-n:])], 200)
            assert (a != np.iinfo(np.uint64).max).all()
            i = len(np.intersect1d(both[:n], both[-n:]))
            hits.append((a == b).mean() - i / (2 * n - i))
        assert abs(np.mean(hits)) < 0.03
    assert (nd.sketches([np.empty(0, np.uint64)], 200) == np.iinfo(np.uint64).max).all()
