"""Top-k against brute force; pseudonyms as permutations of their formats."""
import datetime
import random
import re

import pytest
from helpers import empty, messy, messy_rows  # noqa: F401
from pyspark.sql import functions as F

from cohort.llm import topk
from cohort.llm.pseudonyms import WRITERS, pseudonymised


def brute_topk(rows, k=5, every=50):
    import math
    table = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in table if i % every == 0}:
        # Rows of one query id share its ranks; every row of another id is a candidate.
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for p, v in table if p == q for i, w in table if i != q)[:k]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, topk.BLOCK])
def test_topk_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "RUN", 4)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * s for _ in range(6)]) for i in range(-50, 260) for s in [rng.choice([0.1, 1, 3])]]
    rows += [(500 + i, [0.5, 0.25, 0.0, 0.0, 1.0, -1.0]) for i in range(30)]  # ties
    rows += [(600, None), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (602, [float("nan")] * 6), (603, [float("inf")] * 6), (None, [1.0] * 6),
             (700, []), (750, [0.0] * 6), (100, [9.0] * 6), (100, [9.0] * 6), (800, [1.5, 2.0]), (850, [100000.0] * 6),
             (801, [90000.0] * 6), (801, [90000.0] * 6), (801, [80000.0] * 6), (150, [-3.0] * 6)]  # ids that repeat
    df = spark.createDataFrame([(i, v, [0.0]) for i, v in rows], "vec_id long, embedding array<float>, EMBEDDING array<double>")
    got = sorted(map(tuple, topk.top_inner_products(df).collect()))
    import numpy as np
    want = brute_topk([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert got == want


def test_topk_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_inner_products(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_inner_products(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    two = topk.top_inner_products(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 131072)]


def written_as(spark, kind, values, key="k1"):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(WRITERS[kind](key, F.col("v"))).collect()]


def luhn(s):
    d = [int(c) for c in reversed(re.sub(r"\D", "", s))]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def with_check(body):
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


def shape(s):
    return re.sub("[0-9]", "9", s)


def test_formats_validity_and_permutation(spark):
    rng = random.Random(4)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(d) for d in rng.sample(range(73049), 300)]
    values = {
        "card": [with_check("4" + num(n)) for n in (11, 14, 14, 17) for _ in range(60)],
        "phone": [f"+1 ({rng.randint(100, 999)}) 555-{num(4)}" for _ in range(300)],
        "ssn": [f"{a:03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}" for a in rng.sample(range(1, 900), 200) if a != 666],
        "ip": [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(300)],
        "date": [d.isoformat() for d in days] + [d.strftime("%d.%m.%Y") for d in days] + [d.strftime("%m/%d/%Y") for d in days],
        "mail": [f"n{num(3)}.ab@mail{num(1)}.example.com" for _ in range(100)],
    }
    for kind, vs in values.items():
        vs = list(dict.fromkeys(vs))
        new = written_as(spark, kind, vs)
        assert len(set(new)) == len(vs), kind                       # different values stay different
        assert new == written_as(spark, kind, vs), kind             # equal values stay equal
        assert sum(a == b for a, b in zip(vs, new)) <= 1, kind
        assert sum(a == b for a, b in zip(new, written_as(spark, kind, vs, "k2"))) <= 2, kind
        if kind != "ip":
            assert list(map(shape, new)) == list(map(shape, vs)) or kind == "mail", kind
    cards = written_as(spark, "card", values["card"])
    assert all(map(luhn, cards)) and all(c[0] == "4" for c in cards)
    for fmt, at in (("%Y-%m-%d", 0), ("%d.%m.%Y", 300), ("%m/%d/%Y", 600)):
        got = [datetime.datetime.strptime(x, fmt).date() for x in written_as(spark, "date", values["date"][at:at + 300])]
        assert got == [datetime.date.fromisoformat(x) for x in written_as(spark, "date", values["date"][:300])]
        assert all(1900 <= d.year <= 2099 for d in got)
    assert all(0 <= int(o) <= 255 for x in written_as(spark, "ip", values["ip"]) for o in x.split("."))
    assert all(x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000"
               for x in written_as(spark, "ssn", values["ssn"]))


def test_small_domain_is_a_whole_permutation(spark):
    days = [(datetime.date(1900, 1, 1) + datetime.timedelta(d)).isoformat() for d in range(0, 73049)]
    assert sorted(written_as(spark, "date", days)) == days


def test_texts_are_rewritten_in_place(spark, messy, empty):
    card, ssn = with_check("411111111111111"), "123-45-6789"
    rows = [(1, f"pay {card}, call +1 (212) 555-0100 {card} or mail ann.b@x.example.com."), (2, f"again {card} 😀 {ssn} on 2001-02-29 and 2001-02-28"),
            (3, "order 4111111111111112 v1.2.3.4.5 999.1.1.1 10.0.0.1"), (4, None), (5, ""), (6, "no numbers"), (1, card)]
    got = pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()
    by = {}
    for r, (i, old) in zip(sorted(got, key=lambda r: (str(r["doc_id"]), str(r["text"]))), sorted(rows, key=lambda x: str(x[0]))):
        by.setdefault(r["doc_id"], []).append(r)
    news = {f["pseudonym"] for r in got for f in r["found"] if f["kind"] == "card"}
    assert len(news) == 1 and card not in "".join(r["text"] or "" for r in got)  # one value, one pseudonym, everywhere
    one = next(r["text"] for r in got if r["text"] and r["text"].startswith("pay"))
    assert re.fullmatch(r"pay \d{16}, call \+1 \(\d{3}\) \d{3}-\d{4} \d{16} or mail [a-z]{3}\.[a-z]@[a-z]\.example\.com\.", one)
    two = by[2][0]
    assert "2001-02-29" in two["text"] and "2001-02-28" not in two["text"] and ssn not in two["text"]
    assert [f["kind"] for f in two["found"]] == ["card", "ssn", "date"]
    f = two["found"][1]
    assert rows[1][1][f["start"]:f["end"]] == ssn
    assert by[3][0]["text"].startswith("order 4111111111111112 v1.2.3.4.5 999.1.1.1 ") and "10.0.0.1" not in by[3][0]["text"]
    assert by[4][0]["text"] is None and by[5][0]["text"] == "" and by[6][0]["text"] == "no numbers" and by[6][0]["found"] == []
    out = pseudonymised(messy, "key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert sorted(map(str, (r["text"] for r in out.collect()))) == sorted(str(t) for _, t in messy_rows())
    assert pseudonymised(empty, "key").count() == 0
