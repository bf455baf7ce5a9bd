"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word (A-Z lowered, outer punctuation dropped) is the mean of four hashed embeddings: the word, its
first four and six bytes, its last three. Filters of ``WIDTHS`` words run over the text; the
maximum of each filter over the whole text goes to one logistic unit (Kim, EMNLP 2014). The model is
trained in numpy by AdaGrad on a bounded sample of labelled training documents: at most about
``POSITIVES`` toxic and ``NEGATIVES`` other texts of up to ``SAMPLE_BYTES`` bytes, chosen by a hash of the
id. A fifth of the sample stays out.

Thresholds on the logit come from every labelled training text the network has not learned from, of any
length: one pass measures the training fold, and counts by (guessed language, logit bin, label) reach the
driver. A language with fewer than ``LEAST`` toxic or other texts among them uses the common threshold.

Languages: a text's language is guessed from its own words by naive Bayes learned from the sample, never read
from a column. The score is sigmoid(logit - threshold of the guessed language), so 0.5 is
the calibrated cut everywhere.

Scoring is one narrow pass over whole texts. A filter's response is a sum of one projected row per word, so
each distinct word is hashed and projected once; long texts go through in sections
that overlap by the widest filter, and the maxima meet.

Defined results: null, empty and word-free texts get the score of no words; without both labels in
the sample every score is the share of toxic labels (0 without labels); a document with
several labels counts as toxic if one says so; null labels do not count; repeated rows each give a row.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import bit_of, bitmap_bits, fold, id_bitmap, map_arrow, pick

HELD_OUT, FOLDS = 0, 5
BUCKETS, DIM = 1 << 16, 16
WIDTHS, FILTERS = (1, 2, 3), 12
POSITIVES, NEGATIVES, SAMPLE_BYTES = 2500, 5000, 20_000
LEAST = 10
BINS, BIN_LIMIT = 64, 60  # logit bins a unit, and the logit where they end
EPOCHS, BATCH, RATE = 6, 32, 0.1
KNOWN_BYTES, WORD_BYTES = 40 << 20, 480  # word memory, and what a word takes beside its own bytes
SECTION_WORDS = 1 << 17
_FEATURES = 4
_PAD = WIDTHS[-1] - 1
_EDGE = b".,;:!?()[]{}\"'`<>|*_-"


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def features(word: bytes) -> tuple[int, int, int, int]:
    """Embedding rows of a word."""
    w = word.strip(_EDGE) or word
    h, n = zlib.crc32, BUCKETS - 1
    return h(b"w" + w) & n, h(b"4" + w[:4]) & n, h(b"6" + w[:6]) & n, h(b"s" + w[-3:]) & n


class Network:
    """Embeddings, filters by width, output weights."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.w = [rng.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.float32(0.0)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Word vectors of feature rows."""
        return self.e[rows].mean(1)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """What a word adds to every filter at every place: (words, places, FILTERS)."""
        places = np.concatenate([w for w in self.w])
        return np.einsum("nd,pdf->npf", vectors, places, optimize=True)

    @staticmethod
    def responses(projected: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Filter responses at every word of ``at``; its last ``_PAD`` entries are padding."""
        n, out, place = len(at) - _PAD, [], 0
        for k in WIDTHS:
            r = projected[at[:n], place]
            for j in range(1, k):
                r = r + projected[at[j:n + j], place + j]
            out.append(r)
            place += k
        return np.concatenate(out, 1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.b, 0) @ self.out + self.bias


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


class Vocabulary:
    """Distinct words of the sample as feature rows; row 0 is padding (a zero vector)."""

    def __init__(self, texts: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        for t in texts:
            for w in t:
                if w not in self.number:
                    self.number[w] = len(self.number) + 1
        self.rows = np.array([(0,) * _FEATURES] + [features(w) for w in self.number], np.int64)
        self.texts = [np.array([self.number[w] for w in t] + [0] * _PAD, np.int64) for t in texts]


def trained(texts: list[list[bytes]], labels: np.ndarray) -> Network:
    """AdaGrad on log loss; gradients flow through each filter's maximum only."""
    net, voc, rng = Network(), Vocabulary(texts), np.random.default_rng(3)
    parts = [net.e, *net.w, net.b, net.out]
    sums = [np.full(p.shape, 1e-6, np.float32) for p in parts]
    bias_sum = 1e-6
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    places = sum(WIDTHS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            batch = order[start:start + BATCH]
            ids, inverse = np.unique(np.concatenate([np.zeros(1, np.int64)] + [voc.texts[d] for d in batch]), return_inverse=True)
            vectors = net.vectors(voc.rows[ids])
            vectors[0] = 0.0  # padding
            proj = net.projected(vectors)
            pooled, first, at = np.zeros((len(batch), len(net.b)), np.float32), np.zeros((len(batch), len(net.b)), np.int64), 1
            local = []
            for i, d in enumerate(batch):
                n = len(voc.texts[d])
                local.append(inverse[at:at + n])
                at += n
                r = net.responses(proj, local[-1]) if n > _PAD else np.zeros((1, len(net.b)), np.float32)
                first[i] = r.argmax(0)
                pooled[i] = r.max(0)
            h = np.maximum(pooled + net.b, 0)
            error = ((sigmoid(h @ net.out + net.bias) - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            g_h = error[:, None] * net.out * (pooled + net.b > 0)
            grads = [None, *[np.zeros_like(w) for w in net.w], g_h.sum(0), h.T @ error]
            g_vec = np.zeros_like(vectors)
            for i in range(len(batch)):
                if len(local[i]) <= _PAD:
                    continue
                for k, width in enumerate(WIDTHS):
                    cols = slice(k * FILTERS, (k + 1) * FILTERS)
                    g, p = g_h[i, cols], first[i, cols]
                    for j in range(width):
                        word = local[i][p + j]
                        grads[1 + k][j] += (vectors[word] * g[:, None]).T
                        np.add.at(g_vec, word, net.w[k][j].T * g[:, None])
            g_vec[0] = 0.0
            touched = np.flatnonzero(np.abs(g_vec).any(1))
            rows = voc.rows[ids[touched]]
            uniq, back = np.unique(rows, return_inverse=True)
            g_e = np.zeros((len(uniq), DIM), np.float32)
            np.add.at(g_e, back.reshape(rows.shape), np.repeat(g_vec[touched][:, None] / _FEATURES, _FEATURES, 1))
            sums[0][uniq] += g_e * g_e
            net.e[uniq] -= RATE * g_e / np.sqrt(sums[0][uniq])
            for p, s, g in zip(parts[1:], sums[1:], grads[1:]):
                s += g * g
                p -= RATE * g / np.sqrt(s)
            bias_sum += float(error.sum()) ** 2
            net.bias = np.float32(net.bias - RATE * float(error.sum()) / bias_sum ** 0.5)
    assert places == sum(w.shape[0] for w in net.w)
    return net


def language_table(texts: list[list[bytes]], langs: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Naive Bayes over hashed words: (languages, log probabilities by bucket)."""
    names = sorted({l for l in langs if l is not None})
    counts = np.full((BUCKETS, max(len(names), 1)), 0.1)
    for t, l in zip(texts, langs):
        if l is not None:
            np.add.at(counts[:, names.index(l)], np.array([features(w)[0] for w in t], np.int64), 1.0)
    return names, np.log(counts / counts.sum(0)).astype(np.float32)


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """Threshold with the most F1 on toxic texts, in the middle of the widest gap that has it."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    hit = np.concatenate((np.cumsum(y[::-1])[::-1], [0]))  # toxic at or above cut i
    above = np.arange(len(x), -1, -1)
    f1 = 2 * hit / np.maximum(above + y.sum(), 1)
    edges = np.concatenate(([x[0] - 2.0], x, [x[-1] + 2.0]))
    gap = edges[1:] - edges[:-1]
    top = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = top[np.argmax(gap[top])]
    return float((edges[i] + edges[i + 1]) / 2)


def best_binned_cut(counts: dict[int, list[int]]) -> float:
    """:func:`best_cut` from [other, toxic] counts by logit bin; cuts are edges between bins."""
    bins = np.array(sorted(counts))
    n = np.array([counts[b] for b in bins], np.int64)
    above = np.concatenate((np.cumsum(n[::-1].sum(1))[::-1], [0]))
    hit = np.concatenate((np.cumsum(n[::-1, 1])[::-1], [0]))
    f1 = 2 * hit / np.maximum(above + n[:, 1].sum(), 1)
    low = np.concatenate(([bins[0] - 2.0 * BINS], bins + 1.0))  # upper edge of the bin below a cut
    high = np.concatenate((bins, [bins[-1] + 1 + 2.0 * BINS]))
    top = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = top[np.argmax((high - low)[top])]
    return float((low[i] + high[i]) / 2 / BINS)


class Model:
    """The trained network with language thresholds; scores batches of texts."""

    def __init__(self, net: Network, names: list[str], table: np.ndarray):
        self.net, self.names, self.table = net, names, table
        self.cuts, self.cut = np.zeros(len(names)), 0.0
        self.reset()

    def reset(self) -> None:
        places = sum(WIDTHS)
        self.number: dict[bytes, int] = {}
        self.size = 0
        self.proj = np.zeros((1, places, FILTERS), np.float32)
        self.lang = np.zeros((1, self.table.shape[1]), np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("number", "size", "proj", "lang")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.reset()

    def learn(self, seen: set[bytes]) -> None:
        """Project unseen words; the memory is emptied before it passes ``KNOWN_BYTES``."""
        new = [w for w in seen if w not in self.number]
        cost = lambda words: sum(map(len, words)) + WORD_BYTES * len(words)
        if self.number and self.size + cost(new) > KNOWN_BYTES:
            self.reset()
            new = list(seen)
        if new:
            self.size += cost(new)
            rows = np.array([features(w) for w in new], np.int64)
            self.number.update(zip(new, range(len(self.proj), len(self.proj) + len(new))))
            self.proj = np.concatenate((self.proj, self.net.projected(self.net.vectors(rows))))
            self.lang = np.concatenate((self.lang, self.table[rows[:, 0]]))

    def measured(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, guessed language or -1) of every text."""
        pooled = np.full((len(texts), len(self.net.b)), -np.inf, np.float32)
        votes = np.zeros((len(texts), self.table.shape[1]))
        group: list[tuple[int, list[bytes]]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if group:
                self._section(group, pooled, votes)
            group.clear()
            held = 0

        empty = []
        for i, text in enumerate(texts):
            w = words(text)
            if not w:
                empty.append(i)
            for start in range(0, len(w), SECTION_WORDS):
                part = w[start:start + SECTION_WORDS + _PAD]
                group.append((i, part, len(w) > start + SECTION_WORDS))
                held += len(part)
                if held >= SECTION_WORDS:
                    flush()
        flush()
        pooled[empty] = 0.0
        guess = votes.argmax(1) if self.names else np.full(len(texts), -1)
        guess[empty] = -1
        return self.net.logits(pooled), guess

    def _section(self, group: list[tuple[int, list[bytes], bool]], pooled: np.ndarray, votes: np.ndarray) -> None:
        seen: set[bytes] = set()
        for _, w, _ in group:
            seen.update(w)
        self.learn(seen)
        get = self.number.__getitem__
        # Sections end in padding, or in the words that start the text's next section.
        at = np.concatenate([np.fromiter(map(get, w), np.int64, len(w)) if more else
                             np.append(np.fromiter(map(get, w), np.int64, len(w)), np.zeros(_PAD, np.int64))
                             for _, w, more in group])
        sizes = np.array([len(w) + (0 if more else _PAD) for _, w, more in group])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        docs = np.array([i for i, _, _ in group])
        own = np.ones(len(at), bool)
        for j in range(1, _PAD + 1):
            own[starts + sizes - j] = False  # rows that belong to what follows
        place = 0
        for k, width in enumerate(WIDTHS):
            r = self.proj[at, place]
            for j in range(1, width):
                r[:-j] += self.proj[at[j:], place + j]
            r[~own] = -np.inf
            np.maximum.at(pooled[:, k * FILTERS:(k + 1) * FILTERS], docs, np.maximum.reduceat(r, starts, axis=0))
            place += width
        lang = np.where(own[:, None], self.lang[at], 0.0)
        np.add.at(votes, docs, np.add.reduceat(lang, starts, axis=0))

    def calibrate(self, texts: list[str], labels: np.ndarray) -> None:
        """Thresholds from texts the network has not seen; few toxic texts use the common one."""
        logits, guess = self.measured(texts)
        if labels.any() and not labels.all():
            self.cut = best_cut(logits, labels)
        self.cuts = np.full(len(self.names), self.cut)
        for l in range(len(self.names)):
            mine = guess == l
            if labels[mine].sum() >= LEAST and (1 - labels[mine]).sum() >= LEAST:
                self.cuts[l] = best_cut(logits[mine], labels[mine])

    def binned(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit bin, guessed language) of every text."""
        logits, guess = self.measured(texts)
        return np.floor(np.clip(logits.astype(float), -BIN_LIMIT, BIN_LIMIT) * BINS).astype(np.int32), guess.astype(np.int32)

    def recalibrate(self, counts: list[tuple[int, int, int, int]]) -> None:
        """Thresholds from (guess, logit bin, label, count); without both labels they stay."""
        def table(rows: list[tuple[int, int, int, int]]) -> dict[int, list[int]]:
            out: dict[int, list[int]] = {}
            for _, b, y, n in rows:
                out.setdefault(b, [0, 0])[y] += n
            return out

        totals = lambda t: np.sum(list(t.values()), 0) if t else np.zeros(2)
        whole = table(counts)
        if totals(whole).min() == 0:
            return
        self.cut = best_binned_cut(whole)
        self.cuts = np.full(len(self.names), self.cut)
        for l in range(len(self.names)):
            mine = table([r for r in counts if r[0] == l])
            if totals(mine).min() >= LEAST:
                self.cuts[l] = best_binned_cut(mine)

    def score(self, texts: list[str | None]) -> np.ndarray:
        logits, guess = self.measured(texts)
        cuts = np.append(self.cuts, self.cut)  # the last entry serves guess -1
        return sigmoid(logits.astype(float) - cuts[guess])


def held_back(n: int) -> np.ndarray:
    """Which of ``n`` sample rows the network does not learn from."""
    return np.arange(n) % 5 == 0


def fitted(rows: list[tuple[str, int, str | None]]) -> Model | float:
    """A model from (text, toxic, language) rows, or the share of toxic labels if one kind is missing."""
    labels = np.array([t for _, t, _ in rows], np.int64)
    if not len(rows) or labels.min() == labels.max():
        return float(labels.mean()) if len(rows) else 0.0
    back = held_back(len(rows))
    texts = [words(t) for t, _, _ in rows]
    learn = [t for t, b in zip(texts, back) if not b]
    y = labels[~back]
    if y.min() == y.max():
        return float(labels.mean())
    model = Model(trained(learn, y), *language_table(learn, [l for (_, _, l), b in zip(rows, back) if not b]))
    model.calibrate([t for (t, _, _), b in zip(rows, back) if b], labels[back])
    return model


def outside_counts(texts: DataFrame, marked: DataFrame, model: Broadcast, learned: set) -> list[tuple[int, int, int, int]]:
    """(guess, logit bin, label, count) of all labelled training texts whose id is not in ``learned``.

    Texts are measured where they are; only their ids and bins meet the labels in a join. A bitmap of
    the labelled ids, of fixed size, lets the scan skip nearly all texts without a label.
    """
    sc = texts.sparkSession.sparkContext
    ids = sc.broadcast((learned, id_bitmap(marked.select(bit_of("doc_id").alias("bit")))))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, (seen, bitmap) = model.value, ids.value
        labelled = bitmap_bits(bitmap)
        for b in batches:
            b = b.filter(pa.array(labelled[b.column(2).to_numpy()]))
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                part = part.filter(pa.array([i not in seen for i in part.column(0).to_pylist()], pa.bool_()))
                bins, guess = m.binned(part.column(1).to_pylist())
                yield pa.record_batch({"doc_id": part.column(0), "bin": pa.array(bins), "guess": pa.array(guess)})

    train = (texts.select("doc_id", "text").where("doc_id is not null and text is not null")
                  .where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).withColumn("bit", bit_of("doc_id")))
    bins = map_arrow(train, measure, f"doc_id {dict(texts.dtypes)['doc_id']}, bin int, guess int")
    counts = bins.join(marked, "doc_id").groupBy("guess", "bin", "toxic").count()
    return [tuple(r) for r in counts.collect()]


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None, *, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", carry: str | None = None) -> DataFrame:
    """``[doc_id, held_out, score, predicted]`` for every row of ``docs``.

    Training texts come from ``train_docs`` (``docs`` if not given), training fold only. A column
    named by ``carry`` goes through as ``row``.
    """
    spark = docs.sparkSession
    src = pick(docs, doc_id=id_col, text=text_col, **({"row": carry} if carry else {})).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    marked = (pick(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
              .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
              .where(fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    most = {0: NEGATIVES, 1: POSITIVES}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, min(1.0, most[1] / max(sizes.get(1, 0), 1))).otherwise(
        min(1.0, most[0] / max(sizes.get(0, 0), 1)))
    chosen = F.broadcast(marked.where(draw < share))  # about POSITIVES + NEGATIVES ids
    texts = pick(docs if train_docs is None else train_docs, doc_id=id_col, text=text_col, lang=lang_col)
    rows = sorted(texts.where(F.octet_length("text") <= SAMPLE_BYTES).join(chosen, "doc_id")
                       .select("doc_id", "text", "toxic", "lang").collect(), key=lambda r: (str(r["doc_id"]), r["text"]))
    sample = [(r["text"], r["toxic"], r["lang"]) for r in rows]
    fit = fitted(sample)
    model = spark.sparkContext.broadcast(fit)  # one for both passes, so workers hold one set of known words
    if isinstance(fit, Model):
        learned = {r["doc_id"] for r, b in zip(rows, held_back(len(rows))) if not b}
        fit.recalibrate(outside_counts(texts, marked, model, learned))
    cuts = (fit.cuts, fit.cut) if isinstance(fit, Model) else None
    del rows, sample, fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        if cuts is not None:
            m.cuts, m.cut = cuts
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                score = (m.score(part.column("text").to_pylist()) if isinstance(m, Model)
                         else np.full(part.num_rows, m))
                yield pa.record_batch({k: part.column(k) for k in keep} | {"score": pa.array(score),
                                       "predicted": pa.array((score >= 0.5).astype(np.int32))})

    keep = ["doc_id", *["row"] * bool(carry), "held_out"]
    kept = "".join(f"{k} {dict(src.dtypes)[k]}, " for k in keep)
    return map_arrow(src, run, f"{kept}score double, predicted int")
