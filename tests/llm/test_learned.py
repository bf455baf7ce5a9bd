"""Language model, language identification, toxicity, pipeline."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import empty, frame, messy, messy_rows, prose  # noqa: F401

from pyspark.sql import functions as F

from cohort.llm import class_lm, common, language_id as lid, stages, toxicity as tox
from cohort.llm.class_lm import class_lm_scores

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_lm_counts_and_baseline(messy, empty):
    train, ends, rows = Counter(), 0, []
    for i, t in messy_rows():
        w = t.encode().lower().split() if t else []
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        rows.append((i, held, w))
        if not held:
            train.update(w)
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + 1
    got = class_lm_scores(messy).collect()
    want = [(i, held, len(w) + 1, sum(train[x] > 0 for x in w) + 1, n,
             sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))) for i, held, w in rows]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((w[:5] for w in want), key=str)
    assert np.allclose(sorted(r["base_score"] for r in got), sorted(w[5] for w in want))
    assert any(r["held_out"] for r in got) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert class_lm_scores(empty).count() == 0


def test_lm_probabilities_sum_to_one(monkeypatch):
    monkeypatch.setattr(class_lm, "UNITS", 64)
    rng, nrng = random.Random(1), np.random.default_rng(2)
    words = [b"%s%d" % (rng.choice([b"ab", b"cd", b"ef"]), i) for i in range(300)]
    counts = sorted(((w, rng.choice([1, 1, 2, 9, 50])) for w in words), key=lambda x: (-x[1], x[0]))
    d = 0.4
    for held in (100, 150, 250):  # words in the lexicon, the last time some that are seen once
        lex, rare = class_lm.Lexicon(counts[:held]), counts[held:]
        classes = class_lm.first_classes(lex.size)
        classes[1:] = nrng.integers(1, class_lm.CLASSES, lex.size - 1)
        own = {w: int(nrng.integers(1, class_lm.CLASSES)) for w, c in counts[lex.n_units:] if c > 1}
        of_bucket = lambda w: int(classes[1 + lex.n_units + class_lm.bucket_of(w)])
        head_class = np.array([classes[1 + i] if i < lex.n_units else own.get(w, of_bucket(w)) for i, w in enumerate(lex.words)])
        wide, once, types = np.zeros((2, class_lm.CLASSES)), np.zeros(class_lm.BUCKETS), np.zeros(class_lm.BUCKETS)
        for w, c in counts[lex.n_units:]:
            types[class_lm.bucket_of(w)] += 1
            once[class_lm.bucket_of(w)] += c == 1
            if c > 1:
                wide[:, own[w]] += 1, c
        m = class_lm.Scorer(lex, classes, head_class, wide, once, types, sum(c for _, c in counts), 301, 20, d)
        move = class_lm.transitions(nrng.integers(0, 50, (class_lm.CLASSES, class_lm.CLASSES)))
        # Classes without any word keep the mass that moves to them.
        used = {0, *classes.tolist(), *own.values()}
        for context in (0, 5, 40):
            p = 10 ** move[context]
            total = p[0] * 10 ** m.end + (p[head_class] * 10 ** m.head).sum()
            for w, c in rare:
                total += (p[own[w]] * (c - d) / 10 ** m.total[own[w]] if c > 1 else p[of_bucket(w)] * 10 ** m.once[class_lm.bucket_of(w)])
            total += (p[classes[1 + lex.n_units:]] * 10 ** m.unknown).sum()
            assert abs(total - sum(p[c] for c in used)) < 1e-9


def brute_likelihood(texts, of):
    n2 = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    for t in texts:
        c = [0, *(of[w] for w in t), 0]
        np.add.at(n2, (c[:-1], c[1:]), 1)
    return n2, class_lm.likelihood(n2)


def test_lm_words_move_where_the_likelihood_rises_most():
    rng = random.Random(3)
    texts = [[rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))] for _ in range(60)]
    of = {w: 1 + i % 5 for i, w in enumerate("abcdefghij")}
    n2, _ = brute_likelihood(texts, of)
    for w in "abcdefghij":
        # Neighbours that are the word itself count with its present class, so hide them.
        rest = [t for t in texts if all(x != w or y != w for x, y in zip(t, t[1:]))]
        n2, now = brute_likelihood(rest, of)
        beside = Counter()
        for t in rest:
            for i, x in enumerate(t):
                if x == w:
                    beside[of[t[i + 1]] if i + 1 < len(t) else 0] += 1
                    beside[class_lm.CLASSES + (of[t[i - 1]] if i else 0)] += 1
        k, n = (np.array(x) for x in zip(*sorted(beside.items())))
        got = int(class_lm.moved(n2, np.zeros(len(k), int), k, n, np.array([of[w]]))[0])
        value = {c: brute_likelihood(rest, of | {w: c})[1] for c in range(1, class_lm.CLASSES)}
        assert value[got] > max(value.values()) - 1e-6 and value[got] >= now - 1e-6


@pytest.mark.parametrize("head,units", [(1 << 18, 1 << 14), (40, 8), (1 << 18, 8)])
def test_lm_score_equals_brute_force(spark, monkeypatch, head, units):
    """The model's classes, read back from its own tables, give the same score by plain counting."""
    monkeypatch.setattr(class_lm, "HEAD", head)
    monkeypatch.setattr(class_lm, "UNITS", units)
    rng, seen = random.Random(5), {}
    vocab = [f"w{i}x{i % 7}" for i in range(120)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(120)], k=rng.randint(0, 30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "w1x1 never-seen Never-Seen w2x2")]

    def keep(df, name, write=class_lm.written):
        out = seen[name] = write(df, name)
        return out

    monkeypatch.setattr(class_lm, "written", keep)
    found = {}
    monkeypatch.setattr(class_lm, "clustered", lambda *a, f=class_lm.clustered: found.setdefault("units", f(*a)))
    got = {r["doc_id"]: r for r in class_lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = {i: (t or "").lower().encode().split() for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    n = Counter(w for t in train for w in t)
    classes = found["units"][0]
    order = sorted(n, key=lambda w: (-n[w], w))
    inside = [w for w in order if n[w] > 1][:len(classes) - 1 - class_lm.BUCKETS]
    groups = classes[1 + len(inside):]
    wide = {bytes(r["word"]): r["class"] for r in seen["word-classes"].collect()}
    assert set(wide) == {w for w in n if n[w] > 1} - set(inside)  # every repeated word was exchanged
    of = {w: int(classes[1 + i]) for i, w in enumerate(inside)} | wide
    cls = lambda w: of.get(w, int(groups[class_lm.bucket_of(w)]))
    n2 = np.zeros((class_lm.CLASSES, class_lm.CLASSES))
    for t in train:
        c = [0, *map(cls, t), 0]
        np.add.at(n2, (c[:-1], c[1:]), 1)
    once, twice = (sum(x == k for x in n.values()) for k in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5
    mass = Counter()
    for w in n:
        if w not in inside:
            mass[class_lm.bucket_of(w)] += 1 if n[w] == 1 else d
    size = Counter({0: len(train) + 0.5})
    for w in inside:
        size[of[w]] += n[w] + 0.5
    for w in wide:
        size[of[w]] += n[w] - d
    for b in range(class_lm.BUCKETS):
        size[int(groups[b])] += mass[b] + 0.5
    types = Counter(class_lm.bucket_of(w) for w in n if w not in inside)

    def word(w):
        if w in inside:
            return (n[w] + 0.5) / size[of[w]]
        if w in wide:
            return (n[w] - d) / size[of[w]]
        b = class_lm.bucket_of(w)
        share = (1 - d if w in n else d * types[b]) / mass[b] if mass[b] else 1.0
        return share * (mass[b] + 0.5) / size[int(groups[b])]

    share = (n2.sum(0) + 1) / (n2.sum() + class_lm.CLASSES)
    move = (n2 + class_lm.PRIOR * share) / (n2.sum(1, keepdims=True) + class_lm.PRIOR)
    for i, t in texts.items():
        c = [0, *map(cls, t), 0]
        want = sum(math.log10(move[a, b]) for a, b in zip(c, c[1:])) + sum(math.log10(word(w)) for w in t)
        want += math.log10((len(train) + 0.5) / size[0])
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9)


def test_lm_beats_the_unigram_on_held_out_texts(spark):
    r = class_lm_scores(spark.read.parquet(f"{SF01}/documents.parquet")).where("held_out").selectExpr(
        "sum(base_score) / sum(n_tokens) AS base", "sum(score) / sum(n_tokens) AS score").first()
    assert r["score"] > r["base"] + 0.3
    print("held-out log10 per token", r["base"], r["score"])


def test_exchange_finds_the_two_halves_of_a_vocabulary():
    rng = np.random.default_rng(4)
    text = np.concatenate([rng.integers(1, 401, 30) + 400 * (k % 2) for k in range(2000)])
    classes, values = class_lm.first_classes(801), []
    for turn in range(6):
        after, before = np.zeros((801, class_lm.CLASSES), np.int64), np.zeros((801, class_lm.CLASSES), np.int64)
        np.add.at(after, (text[:-1], classes[text[1:]]), 1)
        np.add.at(before, (text[1:], classes[text[:-1]]), 1)
        values.append(class_lm.likelihood(class_lm.class_bigrams(after, classes)))
        classes = class_lm.exchanged(after, before, classes, turn)
    assert max(values) > values[0] + 0.3 * len(text)


def test_language_id_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = lid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_id_defined_results(spark, messy, empty):
    got = lid.language_id(messy).collect()
    want = sorted(("und" if not t or not any(map(str.isalpha, t)) else "en") for _, t in messy_rows())
    assert sorted(r["lang_pred"] for r in got) == want
    unlabelled = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in lid.language_id(unlabelled).collect()} == {("und", 0.0)}
    assert lid.language_id(empty).count() == 0


def test_language_features_do_not_depend_on_sections(monkeypatch):
    text = prose(1, 200) + "Ünï 😀"
    whole = lid.counts(text)
    monkeypatch.setattr(lid, "SECTION", 17)
    assert (lid.counts(text) == whole).all() and whole.sum() == sum(len(text.lower()) - n for n in range(3))


def small_model():
    rng = random.Random(2)
    rows = []
    for i in range(600):
        w = prose(i, 30).split()
        if i % 4 == 0:
            w.insert(rng.randrange(30), rng.choice(["scum", "idiotic!", "moron"]))
        rows.append((" ".join(w), int(i % 4 == 0), "en"))
    return tox.fitted(rows)


def test_toxicity_learns_and_whole_texts_count(monkeypatch):
    m = small_model()
    clean, bad = prose(9001, 50), prose(9002, 30) + " moron " + prose(9003, 20)
    long_bad = prose(5, 3000) + " scum " + prose(6, 3000)
    a = m.score([clean, bad, long_bad, "", None, " "])
    assert a[0] < 0.5 <= a[1] and a[2] >= 0.5 and a[3] == a[4] == a[5] and 0 <= a.min() and a.max() <= 1
    monkeypatch.setattr(tox, "SECTION_WORDS", 50)
    monkeypatch.setattr(tox, "KNOWN_BYTES", 20_000)
    assert np.allclose(m.score([clean, bad, long_bad, "", None, " "]), a, atol=1e-5)


def test_toxicity_thresholds_come_from_all_labelled_texts(spark, monkeypatch):
    """A language with few toxic texts in the sample, many outside it and some above its length, has its own cut."""
    rng, rows, own = random.Random(4), [], ["der", "hund", "und", "die", "katze", "gehen", "heute", "nach", "haus"]
    for i in range(1200):
        de = i % 10 == 0
        w = [rng.choice(own) for _ in range(30)] if de else prose(i, 30).split()
        bad = rng.random() < 0.4
        if bad:
            w.insert(rng.randrange(30), rng.choice(["scum", "idiotic!", "moron"]))
        if i % 50 == 0:
            w += [rng.choice(own) for _ in range(100)]
        rows.append((i, " ".join(w), "de" if de else "en", int(bad)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    monkeypatch.setattr(tox, "POSITIVES", 120)
    monkeypatch.setattr(tox, "NEGATIVES", 150)
    monkeypatch.setattr(tox, "SAMPLE_BYTES", 400)
    calls, outside, set_cuts = [], tox.outside_counts, tox.Model.recalibrate
    monkeypatch.setattr(tox, "outside_counts", lambda *a: calls.append(len(a[3])) or outside(*a))
    monkeypatch.setattr(tox.Model, "recalibrate", lambda m, counts: calls.extend((m, counts)) or set_cuts(m, counts))
    got = {r["doc_id"]: r for r in tox.toxicity(docs, labels).collect()}
    learned, fit, counts = calls
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % tox.FOLDS != tox.HELD_OUT]
    assert sum(n for *_, n in counts) == len(train) - learned and any(len(r[1]) > 400 for r in train)
    de = fit.names.index("de")
    sums = [sum(n for g, _, y, n in counts if g == de and y == k) for k in (0, 1)]
    assert min(sums) >= tox.LEAST
    mine = {}
    for g, b, y, n in counts:
        if g == de:
            mine.setdefault(b, [0, 0])[y] += n
    assert fit.cuts[de] == tox.best_binned_cut(mine)
    assert sum(got[r[0]]["predicted"] == r[3] for r in rows) >= 0.95 * len(rows)


def test_toxicity_cut_from_bins_equals_the_cut_from_logits():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.3).astype(int)
    x = np.floor((rng.normal(0, 1, 400) + 2.5 * y) * tox.BINS)
    counts = {}
    for b, k in zip(x, y):
        counts.setdefault(int(b), [0, 0])[k] += 1
    f1 = lambda c: 2 * (y[x >= c * tox.BINS].sum()) / ((x >= c * tox.BINS).sum() + y.sum())
    assert f1(tox.best_binned_cut(counts)) == max(f1(b / tox.BINS) for b in {*x, x.max() + 1})


def test_toxicity_defined_results(spark, messy, empty):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int, TOXIC int")
    for rows, score in (([], 0.0), ([(1, 1, 0), (1, 0, 0), (2, 1, 0), (None, 0, 0), (9, None, 0)], None)):
        got = tox.toxicity(messy, labels(rows)).collect()
        assert len(got) == len(messy_rows()) and len({r["score"] for r in got}) == 1
        assert score is None or got[0]["score"] == score
    assert tox.toxicity(empty, labels([])).count() == 0


def test_stages_keep_clashing_columns_and_do_what_they_say(spark, messy, empty):
    names = messy.columns
    for stage in (stages.drop_toxic, stages.drop_near_duplicates, stages.drop_contaminated, stages.redact_secrets):
        out = stage(spark, messy, SF001)
        assert out.columns == names and 0 < out.count() <= messy.count()
        assert stage(spark, empty, SF001).count() == 0
    kept = [r["doc_id"] for r in stages.drop_near_duplicates(spark, messy, SF001).collect()]
    assert sum(i in (1, 2) for i in kept) == 1 and sum(i in (9, -10) for i in kept) == 1 and kept.count(None) == 2
    same = spark.createDataFrame([(None, prose(7, 30))] * 5 + [(3, prose(8, 30))] * 5, "doc_id long, text string")
    assert sorted(map(str, (r["doc_id"] for r in stages.drop_near_duplicates(spark, same, SF001).collect()))) == ["3", "None"]
    encoded = stages.encode_texts(spark, messy, SF001)
    assert encoded.columns == ["doc_id", "n_tokens", "ids", "decoded"] and encoded.count() == messy.count()
    assert stages.encode_texts(spark, empty, SF001).count() == 0
    rows = spark.createDataFrame([(1, "password=hunter2hunter2 ok", 3), (2, None, 4)], "doc_id long, text string, n_chars int")
    assert sorted(map(tuple, stages.redact_secrets(spark, rows, SF001).collect())) == [(1, "[SECRET] ok", 3), (2, None, 4)]


def test_rows_are_not_shuffled_to_drop_a_few(spark):
    """The numbers of lost rows are written before the join, so a short list never moves the table's rows."""
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    table, uid = common.numbered(docs, "test-rows")
    first = sorted(r[uid] for r in table.select(uid).collect())[:7]
    # Like the operators' results, this table has no size that the planner knows.
    lost = spark.createDataFrame(spark.sparkContext.parallelize([(u,) for u in first]), "uid long")
    out = common.without(table, lost)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan, plan
    assert out.columns == ["doc_id", "text"] and out.count() == 43


def test_pipeline_runs_whole(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = corpus_pipeline.run(spark, SF001)
    rows = out.collect()
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and 0 < len(rows) < docs.count()
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    secret = {r["doc_id"]: r["decoded"] for r in rows}
    assert not any("AKIA" in t for t in secret.values())


@pytest.mark.parametrize("modulus", [5, 7])
def test_folds(spark, modulus):
    from pyspark.sql import functions as F

    from cohort.llm.common import fold, fold_of
    ids = [*range(-50, 50), None]
    df = spark.createDataFrame([(i,) for i in ids], "i long").withColumn("f", fold(F.col("i"), modulus))
    assert all(r["f"] == fold_of(r["i"], modulus) for r in df.collect())
