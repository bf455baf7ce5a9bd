"""Centroid clustering, cross-tokenizer alignment and SentencePiece against brute force."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohort.llm import catalog, sentence_pieces
from cohort.llm.centroid_clustering import VantageTree, cluster_vectors, first_vectors, whole_vectors, with_inertia
from cohort.llm.sentence_pieces import MARK, PieceTable
from cohort.llm.token_alignment import align, merge, scored, pair_counts, token_alignment
from cohort.llm.common import written
from helpers import empty, frame, messy, messy_rows, prose  # noqa: F401

A, B = (catalog.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [" ", "  ", MARK, "\n", "a", "bc", "é", "　", "<s>", "</s>", "<0x41>", "<|endoftext|>", "😀", "\x00", "\x85",
         "the", " hello", "don't", "12", "\t", "́", " \n"]


def odd_texts(n: int, seed: int = 5) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(12))) for _ in range(n)]


# -- clustering ------------------------------------------------------------- #

def brute_clusters(rows, k, rounds, dim, scale=1024, seed=3):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for n, vs in members.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in out)


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.integers(-2, 3, (300, 6)) / 3)]
    rows += [(1000, [0.0] * 6)] * 40 + [(7, [1.0] * 6), (None, [0.25] * 6), (500, None), (501, [1.0] * 5), (502, [None] + [1.0] * 5),
                                        (503, [float("nan")] * 6), (504, [float("inf")] * 6), (505, []), (506, [1.0] * 7)]
    return rows


@pytest.mark.parametrize("k,rounds", [(1, 2), (8, 10), (23, 4)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows],
                               "vec_id long, embedding array<float>, VEC_ID string, distance int").repartition(5)
    found = with_inertia(*cluster_vectors(df, dim=6, k=k, rounds=rounds)).collect()
    assert Counter(map(tuple, found)) == brute_clusters(rows, k, rounds, 6)


def test_clusters_of_few_equal_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.5, 0.5])]
    found = with_inertia(*cluster_vectors(spark.createDataFrame(rows, schema), dim=2, k=8)).collect()
    assert {(r["cluster"], r["distance"]) for r in found} == {(0, 0)} and len(found) == 3
    for none in ([], [(1, None)], [(1, [float("nan"), 1.0])]):
        assert with_inertia(*cluster_vectors(spark.createDataFrame(none, schema), dim=2)).count() == 0
    with pytest.raises(Exception, match="component beyond"):
        cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], schema), dim=2)


def test_tree_search_is_exact_with_ties():
    rng = np.random.default_rng(1)
    for k in (1, 4, 5, 60, 300):
        c = rng.integers(-3, 4, (k, 3))
        x = rng.integers(-4, 5, (500, 3))
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        number, distance = VantageTree(c).nearest(x)
        assert (number == d.argmin(1)).all() and (distance == d.min(1)).all()
    far = np.array([[(1 << 27) - 1, -(1 << 27)], [-(1 << 27), 1 << 27]])
    number, distance = VantageTree(far).nearest(far[::-1].copy())
    assert number.tolist() == [1, 0] and distance.tolist() == [0, 0]


def test_first_vectors_follow_the_hash(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(50)], "vec_id long, embedding array<double>")
    want = sorted(range(50), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:8]
    found = first_vectors(whole_vectors(df, "vec_id", "embedding", 1, 1), 8, 1, 3)
    assert found[:, 0].tolist() == want


# -- alignment -------------------------------------------------------------- #

def token_bytes():
    from cohort.llm.bpe import Vocabulary
    a, sp = Vocabulary(A).tokens, sentencepiece.SentencePieceProcessor(model_file=B)
    b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode()
         for i in range(sp.get_piece_size())]
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sp, a, b


def brute_alignment(rows):
    tok, sp, a_bytes, b_bytes = token_bytes()
    docs = []
    for i, text in rows:
        x = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        y = sp.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes[t] for t in x) != whole or b"".join(b_bytes[t] for t in y) != whole:
            x, y = [], []
        end_x = np.cumsum([len(a_bytes[t]) for t in x]).tolist()
        end_y = np.cumsum([len(b_bytes[t]) for t in y]).tolist()
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(end_x) & set(end_y)):
            i2, j2 = end_x.index(end, p), end_y.index(end, q)
            groups.append(",".join(map(str, x[p:i2 + 1])) + "|" + ",".join(map(str, y[q:j2 + 1])))
            links.append((x[i2], y[j2]))
            p, q = i2 + 1, j2 + 1
        docs.append((i, len(x), len(y), len(groups), len(links), ";".join(groups), links))
    count = Counter(link for d in docs for link in d[-1])
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return Counter((*d[:6], sum(count[k] == most[k[1]] for k in d[6]), sum(count[k] for k in d[6])) for d in docs)


@pytest.mark.parametrize("frequent", [0, 5, 1 << 19])
def test_alignment_equals_brute_force(spark, frequent):
    rows = [r for r in messy_rows() if not r[1] or len(r[1]) < 20_000]
    rows += [(100 + i, t) for i, t in enumerate(odd_texts(300))]
    df = frame(spark, rows).repartition(7)
    found = token_alignment(align(df, A, B), frequent=frequent).select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "groups", "n_best", "count_sum").collect()
    assert Counter(map(tuple, found)) == brute_alignment(rows)


def test_alignment_of_long_texts_and_clashing_columns(spark, messy, empty):  # noqa: F811
    docs = align(messy, A, B).collect()
    by_id = {r["doc_id"]: r for r in docs}
    long = prose(1, 30_000)
    one = brute_alignment([(6, long)])
    assert len(docs) == len(messy_rows())
    assert next(iter(one))[1:6] == tuple(by_id[6][c] for c in ("n_a", "n_b", "n_links", "n_links", "groups"))
    assert (by_id[3]["n_a"], by_id[4]["groups"], by_id[4]["n_links"]) == (0, "", 0)
    assert token_alignment(align(empty, A, B)).count() == 0


def test_counts_are_whole_without_broadcast_pairs(spark):
    table = written(align(frame(spark, [(i, prose(i % 3, 40)) for i in range(30)]), A, B), "t")
    counts = written(pair_counts(table), "c")
    same = [scored(table, counts, frequent=n).select("doc_id", "n_best", "count_sum").orderBy("doc_id").collect()
            for n in (0, 3, 1000)]
    assert same[0] == same[1] == same[2]


def test_lockstep_merge_equals_intersection():
    rng = np.random.default_rng(2)
    for _ in range(50):
        lanes = [(np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 20), replace=False)),
                  np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 20), replace=False))) for _ in range(rng.integers(0, 9))]
        lanes = [(np.append(a, 40) + 40 * i, np.append(b, 40) + 40 * i) for i, (a, b) in enumerate(lanes)]
        a, b = (np.concatenate([x[s] for x in lanes] or [np.empty(0, int)]) for s in (0, 1))
        count = [np.array([len(x[s]) for x in lanes], np.int64) for s in (0, 1)]
        p, q = merge(a, b, *count)
        both, i, j = np.intersect1d(a, b, return_indices=True)
        assert p.tolist() == i.tolist() and q.tolist() == j.tolist()


# -- SentencePiece ---------------------------------------------------------- #

def test_pieces_equal_the_library():
    table, sp = PieceTable(B), sentencepiece.SentencePieceProcessor(model_file=B)
    assert table.separable
    texts = odd_texts(3000) + [t or "" for _, t in messy_rows()]
    for text, ids in zip(texts, table.encode(texts)):
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert table.decode(ids) == sp.decode(want)


def test_any_ids_decode_as_the_library():
    table, sp, rng = PieceTable(B), sentencepiece.SentencePieceProcessor(model_file=B), random.Random(3)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 3, 35, 200, 230, 259, 264, 28705, rng.randrange(32000)]) for _ in range(rng.randrange(8))]
        assert table.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids)


def test_full_and_disabled_tables_change_nothing(monkeypatch):
    texts = [prose(i, 300) for i in range(20)] + odd_texts(50)
    want = PieceTable(B).encode(texts)
    monkeypatch.setattr(sentence_pieces, "CACHE_BYTES", 10)
    monkeypatch.setattr(sentence_pieces, "BATCH_CHARS", 500)
    assert PieceTable(B).encode(texts) == want
    whole = PieceTable(B)
    whole.separable = False
    assert whole.encode(texts) == want and [whole.decode(x) for x in want] == [PieceTable(B).decode(x) for x in want]


def test_piece_rows(spark, messy, empty):  # noqa: F811
    rows = sentence_pieces.encode(messy, B, decoded=True)
    text = {i: t for i, t in messy_rows()}
    for r in rows.collect():
        if r["doc_id"] is not None:
            assert r["decoded"] == (text[r["doc_id"]] or "").replace(MARK, " ")
        assert r["n_tokens"] == len(r["ids"]) // 4 >= 2
    assert rows.count() == len(messy_rows())
    back = sentence_pieces.decode(rows.drop("decoded"), B).where("doc_id = 8").first()
    assert back["text"] == text[8]
    assert sentence_pieces.encode(empty, B).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert sentence_pieces.decode(none, B).first()["text"] is None
