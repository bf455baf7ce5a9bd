"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: hashed n-grams of 1 to ``ORDERS`` code points of the lower-cased text. Document
frequencies cover every training document, summed in tasks and then by block. Weights are
fitted by follow-the-regularised-leader (McMahan et al., KDD 2013) with elastic-net
penalties on a sample of at most about ``PER_LANGUAGE`` training documents a language, chosen by a
hash of the id; a fifth of the sample stays out and sets the temperature that makes the
probabilities honest. The sample's sparse vectors are what reaches the driver, and its size
is bounded by that parameter. Prediction is one narrow pass over whole texts.

Learning uses only text and non-null language of the training fold; a prediction uses
the text alone.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text
if nothing could be learned; ties go to the first language by name; texts of any length
are read in sections; repeated rows each give a row.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import fold, map_arrow, pick

HELD_OUT, FOLDS = 0, 5
ORDERS, BITS = 3, 16
SIZE = 1 << BITS
SECTION = 1 << 20
PER_LANGUAGE = 1000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
_BLOCK = 1 << 12


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype(np.uint64)
    out = np.zeros(SIZE, np.int64)
    for start in range(0, len(points), SECTION):
        part = points[start:start + SECTION + ORDERS - 1]
        h = np.zeros(len(part), np.uint64)
        for n in range(1, ORDERS + 1):
            h = h[:len(part) - n + 1]
            if not len(h):
                break
            h = (h + part[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            own = h[:min(SECTION, len(points) - start - n + 1)]
            out += np.bincount((own >> np.uint64(64 - BITS)).astype(np.int64), minlength=SIZE)
    return out


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents of ``docs[text]`` that hold each feature; the last entry counts the documents."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                total += counts(text) > 0
                n += 1
        parts = [total[i:i + _BLOCK] for i in range(0, SIZE, _BLOCK)] + [np.array([n])]
        yield pa.record_batch({"block": pa.array(range(len(parts)), pa.int32()),
                               "n": pa.array([p.astype(np.int64).tobytes() for p in parts], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "n": [sum(np.frombuffer(x, np.int64) for x in pdf["n"]).tobytes()]})

    rows = (map_arrow(docs.select("text"), part, "block int, n binary").groupBy("block")
            .applyInPandas(add, "block int, n binary").collect())
    blocks = [np.frombuffer(r["n"], np.int64) for r in sorted(rows, key=lambda r: r["block"])]
    return np.concatenate(blocks) if blocks else np.zeros(SIZE + 1, np.int64)


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and values of unit length: (1 + log tf) * idf."""
    c = counts(text)
    at = np.flatnonzero(c)
    v = (1.0 + np.log(c[at])) * idf[at]
    return at, v / max(float(np.sqrt(v @ v)), 1e-12)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Per-coordinate FTRL-proximal for multinomial logistic loss; weights are (SIZE + 1, classes)."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def step(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(v @ w)
        error[label] -= 1.0
        g = v[:, None] * error
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor that gives held-back logits the least log loss."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20.0, 121)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fitted(sample: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, float]:
    """(weights, temperature) from (label, features, values) rows."""
    with_bias = [(y, np.append(at, SIZE), np.append(v, 1.0)) for y, at, v in sample]
    learn = [r for i, r in enumerate(with_bias) if i % 5]
    back = [r for i, r in enumerate(with_bias) if i % 5 == 0]
    model, rng = Ftrl(classes), np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(learn)):
            y, at, v = learn[i]
            model.step(at, v, y)
    w = model.weights(slice(None))
    logits = np.array([v @ w[at] for _, at, v in back]).reshape(len(back), classes)
    return w.astype(np.float32), temperature(logits, np.array([y for y, _, _ in back], np.int64))


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                per_language: int = PER_LANGUAGE) -> DataFrame:
    """``[doc_id, held_out, lang_pred, score]``, one row per input row."""
    spark = docs.sparkSession
    src = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn(
        "held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    train = src.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    df = document_frequencies(train)
    idf = np.log((1.0 + df[SIZE]) / (1.0 + df[:SIZE])) + 1.0
    shared_idf = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, lang, text in zip(*(c.to_pylist() for c in b.columns)):
                at, v = vector(text, shared_idf.value)
                yield pa.record_batch({"doc_id": pa.array([str(doc_id)]), "lang": pa.array([lang], pa.string()),
                                       "at": pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                                       "v": pa.array([v.astype(np.float32).tobytes()], pa.binary())})

    share = F.create_map(*[F.lit(x) for l in langs for x in (l, min(1.0, per_language / sizes[l]))]) if langs else None
    sample = []
    if langs:
        draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
        chosen = train.where(draw < share[F.col("lang")])
        rows = map_arrow(chosen.select("doc_id", "lang", "text"), vectors,
                         "doc_id string, lang string, at binary, v binary").collect()
        number = {l: i for i, l in enumerate(langs)}
        sample = [(number[r["lang"]], np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["v"], np.float32))
                  for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["at"])))]
    weights, heat = fitted(sample, len(langs)) if sample else (np.zeros((SIZE + 1, 0), np.float32), 1.0)
    model = spark.sparkContext.broadcast((weights, heat, langs))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, t, names = model.value
        for b in batches:
            pred, score = [], []
            for text in b.column(2).to_pylist():
                if not names or not text or not any(map(str.isalpha, text)):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                at, v = vector(text, shared_idf.value)
                p = softmax((v.astype(np.float32) @ w[at] + w[SIZE]).astype(float) / t)
                best = int(p.argmax())
                pred.append(names[best])
                score.append(float(p[best]))
            yield pa.record_batch({"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": pa.array(pred, pa.string()),
                                   "score": pa.array(score, pa.float64())})

    return map_arrow(src.select("doc_id", "held_out", "text"), predict,
                     f"doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
