"""Language-model scores from Brown's class-based n-grams.

P(text) is the product over tokens of P(class | class before) * P(word | class). Words are
put into classes by exchange clustering: every unit moves to the class that raises the
class-bigram likelihood most while the counts stay fixed, half of the units at a time, in
the distributed form of Uszkoreit and Brants (ACL 2008).

Every word seen at least twice gets its class by exchange, in two steps:

* the ``UNITS`` most frequent words, and ``BUCKETS`` groups of all other words by their last three
  bytes, are exchanged against each other in rounds. Their matrices (units x classes) have a
  fixed size and are what reaches the driver;
* every other repeated word then leaves its group for the class that raises the likelihood most.
  Its counts beside every class are summed in one shuffle by word and judged inside tasks against
  the broadcast class matrix. The classes stay a distributed table; only those of the ``HEAD`` most frequent
  words are broadcast, all others are joined to the places where the words stand.

Words seen once, and unknown words, keep the class of their group. Word counts cover every training token and
stay a distributed table. Texts are encoded once into a written table, so a round reads integers, and once
more into classes, one byte a token.

Smoothing: class bigrams are drawn to the class unigrams by ``PRIOR`` pseudo-counts; the
``UNITS`` words and the groups get half a count more; every other repeated word gives
D = n1 / (n1 + 2 n2) of a count to its group, as does every word seen once, and that mass is the group's unknown
word. The probabilities of all known words and one unknown word per group sum to one in every context.

The baseline is the add-one unigram of the same tokens: log10((c + 1) / (N + V + 1)).

Defined results: a null or empty text is one end token; texts without an id are training
texts; without training texts every token is unknown; repeated rows each give a row and
count each; words of any length are kept whole.
"""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import fold, map_arrow, pick, sections, written

HELD_OUT, FOLDS = 2, 7
HEAD, UNITS, BUCKETS, CLASSES = 1 << 18, 1 << 14, 1 << 11, 64
ROUNDS = 6
PRIOR = 20.0
FLUSH_WORDS = 300_000
ROUND_TOKENS = 64 << 20
MOVE_RECORDS = 1 << 15
BLOCK_UNITS = 512


def words(text: str | None) -> Iterator[list[bytes]]:
    """The text's words (A-Z lowered, ASCII white space between), a section at a time."""
    for part in sections(text.encode().lower()) if text else ():
        yield part.split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``[word, n]`` over ``docs[text]``, summed inside tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return out

        for b in batches:
            for text in b.column(0).to_pylist():
                for part in words(text):
                    seen.update(part)
                if len(seen) >= FLUSH_WORDS:
                    yield flush()
        yield flush()

    parts = map_arrow(docs.select("text"), run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def bucket_of(word: bytes) -> int:
    """Group of a word outside the ``UNITS``: a hash of its last three bytes."""
    return zlib.crc32(word[-3:]) % BUCKETS


def _bucket(word: str) -> F.Column:
    return F.crc32(F.substring(word, -3, 3)) % BUCKETS


class Lexicon:
    """The frequent words in falling order, with counts; the first ``UNITS`` that repeat are units of their own.

    Units: 0 is the end of a text, then the words, then the buckets. ``repeated`` words are seen at least twice.
    """

    def __init__(self, head: list[tuple[bytes, int]]):
        self.words = [w for w, _ in head]
        self.counts = np.array([n for _, n in head], np.int64)
        self.repeated = int((self.counts >= 2).sum())
        self.n_units = min(UNITS, self.repeated)
        buckets = np.array([bucket_of(w) for w in self.words[self.n_units:]], np.int64)
        self.unit = np.concatenate((np.arange(1, self.n_units + 1), 1 + self.n_units + buckets)).astype(np.int32)
        self.size = 1 + self.n_units + BUCKETS

    def units(self, codes: np.ndarray) -> np.ndarray:
        """Unit of every code; a code is a head index, or -1 - bucket."""
        if not len(self.unit):
            return self.n_units - codes
        return np.where(codes >= 0, self.unit[np.maximum(codes, 0)], self.n_units - codes)


def encoded(docs: DataFrame, lexicon) -> DataFrame:
    """``[row, doc_id, held_out, codes, rare]``: codes as 32-bit integers, other words with their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        get = {w: i for i, w in enumerate(lexicon.value.words)}.get
        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("at", pa.list_(pa.int32()))]))
        for b in batches:
            ids, held = b.column(0), b.column(2)
            for start in range(0, b.num_rows, 512):
                codes, rare = [], []
                for text in b.column(1).slice(start, 512).to_pylist():
                    parts, others, at = [], {}, 0
                    for w in words(text):
                        c = np.fromiter(map(get, w, repeat(-1)), np.int32, len(w))
                        for i in np.flatnonzero(c < 0).tolist():
                            others.setdefault(w[i], []).append(at + i)
                            c[i] = -1 - bucket_of(w[i])
                        parts.append(c)
                        at += len(w)
                    codes.append(b"".join(c.tobytes() for c in parts))
                    rare.append([{"word": w, "at": at} for w, at in others.items()])
                n = len(codes)
                yield pa.record_batch({
                    "row": pa.array(range(row, row + n), pa.int64()), "doc_id": ids.slice(start, 512),
                    "held_out": held.slice(start, 512), "codes": pa.array(codes, pa.binary()),
                    "rare": pa.array(rare, rare_type)})
                row += n

    return map_arrow(docs, run, f"row long, doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, codes binary, "
                                "rare array<struct<word:binary,at:array<int>>>")


def neighbours(table: DataFrame, lexicon, classes: np.ndarray, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every unit's following and preceding classes, summed over all texts."""
    size, shared = len(classes), table.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, lex = shared.value.astype(np.int64), lexicon.value
        after, before = np.zeros(size * CLASSES, np.int64), np.zeros(size * CLASSES, np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            u = np.concatenate([np.zeros(1, np.int64), *held])
            c = cls[u]
            after[:] += np.bincount(u[:-1] * CLASSES + c[1:], minlength=size * CLASSES)
            before[:] += np.bincount(u[1:] * CLASSES + c[:-1], minlength=size * CLASSES)
            held.clear()

        n = 0
        for b in batches:
            for codes in b.column(0).to_pylist():
                held += [lex.units(np.frombuffer(codes, np.int32)).astype(np.int64), np.zeros(1, np.int64)]
                n += len(codes) // 4
                if n > 1 << 20:
                    add()
                    n = 0
        if held:
            add()
        width = BLOCK_UNITS * CLASSES
        for i in range(0, size * CLASSES, width):
            yield pa.record_batch({"block": pa.array([i // width], pa.int32()),
                                   "after": pa.array([after[i:i + width].tobytes()], pa.binary()),
                                   "before": pa.array([before[i:i + width].tobytes()], pa.binary())})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        add = lambda col: sum(np.frombuffer(x, np.int64) for x in col).tobytes()
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "after": [add(pdf["after"])], "before": [add(pdf["before"])]})

    schema = "block int, after binary, before binary"
    parts = map_arrow(table.where("not held_out").select("codes").coalesce(tasks), count, schema)
    rows = sorted(parts.groupBy("block").applyInPandas(total, schema).collect(), key=lambda r: r["block"])
    join = lambda k: np.frombuffer(b"".join(r[k] for r in rows), np.int64).reshape(-1, CLASSES)
    return (join("after"), join("before")) if rows else (np.zeros((size, CLASSES), np.int64),) * 2


def class_bigrams(after: np.ndarray, classes: np.ndarray) -> np.ndarray:
    out = np.zeros((CLASSES, CLASSES), np.int64)
    np.add.at(out, classes, after)
    return out


def likelihood(bigrams: np.ndarray) -> float:
    """The class-dependent part of the corpus log-likelihood."""
    x = lambda a: float((a[a > 0] * np.log(a[a > 0].astype(float))).sum())
    return x(bigrams) - x(bigrams.sum(0)) - x(bigrams.sum(1))


def first_classes(size: int) -> np.ndarray:
    """Class 0 for the end; the most frequent words open a class each, the rest shares the last."""
    return np.minimum(np.arange(size), CLASSES - 1).astype(np.int16)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchanged(after: np.ndarray, before: np.ndarray, classes: np.ndarray, turn: int) -> np.ndarray:
    """Classes after half of the units moved to where the likelihood rises most, all others held fixed."""
    n2 = class_bigrams(after, classes).astype(float)
    rows, cols, g_rows, g_cols = n2.sum(1), n2.sum(0), _xlogx(n2), _xlogx(n2.T)
    out = classes.copy()
    moving = np.flatnonzero((np.arange(len(classes)) % 2 == turn % 2) & (np.arange(len(classes)) > 0) & (after.sum(1) > 0))
    for start in range(0, len(moving), 256):
        u = moving[start:start + 256]
        a, s, p = classes[u], after[u].astype(float), before[u].astype(float)
        n, m = s.sum(1), p.sum(1)
        leave = ((_xlogx(n2[a] - s) - g_rows[a]).sum(1) + (_xlogx(n2.T[a] - p) - g_cols[a]).sum(1)
                 - _xlogx(rows[a] - n) + _xlogx(rows[a]) - _xlogx(cols[a] - m) + _xlogx(cols[a]))
        join = ((_xlogx(n2[None] + s[:, None]) - g_rows).sum(2) + (_xlogx(n2.T[None] + p[:, None]) - g_cols).sum(2)
                - _xlogx(rows + n[:, None]) + _xlogx(rows) - _xlogx(cols + m[:, None]) + _xlogx(cols))
        join[:, 0] = -np.inf  # the end's class
        join[np.arange(len(u)), a] = -leave  # staying changes nothing
        best = join.argmax(1)
        out[u] = np.where(join[np.arange(len(u)), best] > -leave, best, a)
    return out


def clustered(table: DataFrame, lexicon, size: int, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """Exchange clustering: the best classes found and the matching counts of following classes."""
    classes, best = first_classes(size), None
    for turn in range(ROUNDS + 1):
        after, before = neighbours(table, lexicon, classes, tasks)
        value = likelihood(class_bigrams(after, classes))
        if best is None or value > best[0]:
            best = (value, classes, after)
        if turn < ROUNDS:
            classes = exchanged(after, before, classes, turn)
    return best[1], best[2]


def wide_counts(table: DataFrame, lexicon, classes: np.ndarray) -> DataFrame:
    """``[word, beside]`` of repeated words that are no units: ``beside`` lists (k, n), where k is the class
    that follows, or CLASSES + the class before."""
    shared = table.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, lex = shared.value.astype(np.int64), lexicon.value
        names = pa.array(lex.words, pa.binary())

        def out(names: pa.Array, who: np.ndarray, at: np.ndarray, seq: np.ndarray) -> pa.RecordBatch:
            key = np.concatenate((who * (2 * CLASSES) + seq[at + 1], who * (2 * CLASSES) + CLASSES + seq[at - 1]))
            key, n = np.unique(key, return_counts=True)
            return pa.record_batch({"word": names.take(pa.array(key // (2 * CLASSES))),
                                    "k": pa.array((key % (2 * CLASSES)).astype(np.int16)), "n": pa.array(n.astype(np.int64))})

        for b in batches:
            rows = [np.frombuffer(c, np.int32) for c in b.column(0).to_pylist()]
            start = np.cumsum([1] + [len(r) + 1 for r in rows])  # each text between two ends
            code = np.full(start[-1], -1, np.int64)
            seq = np.zeros(start[-1], np.int64)
            for i, r in zip(start, rows):
                code[i:i + len(r)] = r
                seq[i:i + len(r)] = cls[lex.units(r)]
            at = np.flatnonzero((code >= lex.n_units) & (code < lex.repeated))
            yield out(names, code[at], at, seq)
            rare = b.column(1)
            entries = rare.flatten()
            word, places = entries.field(0).dictionary_encode(), entries.field(1)
            n = places.value_lengths().to_numpy(zero_copy_only=False)
            of_row = np.repeat(start[:-1], rare.value_lengths().to_numpy(zero_copy_only=False))
            at = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(of_row, n)
            yield out(word.dictionary, np.repeat(word.indices.to_numpy(zero_copy_only=False).astype(np.int64), n), at, seq)

    parts = map_arrow(table.where("not held_out").select("codes", "rare"), count, "word binary, k short, n long")
    return (parts.repartition("word").groupBy("word", "k").agg(F.sum("n").alias("n"))
                 .groupBy("word").agg(F.collect_list(F.struct("k", "n")).alias("beside"),
                                      F.sum(F.when(F.col("k") < CLASSES, F.col("n"))).alias("n"))
                 .where("n >= 2"))  # words seen once stay in their group


def moved(bigrams: np.ndarray, word: np.ndarray, k: np.ndarray, n: np.ndarray, current: np.ndarray) -> np.ndarray:
    """The class that raises the likelihood most for every word, all others held fixed.

    Records (word position, k, n) are in the order of the words, of which each has some.
    """
    n2 = bigrams.astype(float)
    beside = np.concatenate((n2.T, n2))  # by k, then by the word's class
    g, rows, cols = _xlogx(beside), n2.sum(1), n2.sum(0)
    first = np.searchsorted(word, np.arange(len(current)))
    a, n = current[word], n.astype(float)
    join = np.add.reduceat(_xlogx(beside[k] + n[:, None]) - g[k], first)
    leave = np.add.reduceat(_xlogx(beside[k, a] - n) - g[k, a], first)
    s, p = (np.bincount(word, np.where(side, n, 0.0), len(current)) for side in (k < CLASSES, k >= CLASSES))
    a = current
    join += (_xlogx(rows) - _xlogx(rows + s[:, None])) + (_xlogx(cols) - _xlogx(cols + p[:, None]))
    leave += _xlogx(rows[a]) - _xlogx(rows[a] - s) + _xlogx(cols[a]) - _xlogx(cols[a] - p)
    join[:, 0] = -np.inf  # the end's class
    at = np.arange(len(a))
    join[at, a] = -leave  # staying changes nothing
    best = join.argmax(1)
    return np.where(join[at, best] > -leave, best, a)


def wide_classes(counts: DataFrame, lexicon: Lexicon, classes: np.ndarray, bigrams: np.ndarray) -> DataFrame:
    """``[word, class, n]`` from :func:`wide_counts`."""
    shared = counts.sparkSession.sparkContext.broadcast((bigrams, classes[1 + lexicon.n_units:].astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n2, groups = shared.value
        for b in batches:
            lists = b.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            k, n = (lists.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            current = groups[[bucket_of(w) for w in b.column(0).to_pylist()]] if b.num_rows else np.zeros(0, np.int64)
            out, i = [], 0
            while i < len(sizes):
                low = ends[i] - sizes[i]
                j = max(i + 1, int(np.searchsorted(ends, low + MOVE_RECORDS, "right")))
                part = slice(low, ends[j - 1])
                out.append(moved(n2, np.repeat(np.arange(j - i), sizes[i:j]), k[part], n[part], current[i:j]))
                i = j
            yield pa.record_batch({"word": b.column(0), "class": pa.array(np.concatenate(out or [current]).astype(np.int16)),
                                   "n": b.column(2)})

    return map_arrow(counts.select("word", "beside", "n"), run, "word binary, class short, n long")


class Scorer:
    """Log10 tables of the finished model; all sizes are fixed by the parameters above.

    ``head_class`` holds a class for every word of the lexicon, ``wide`` (words, tokens) by class of all repeated
    words that are no units, ``once`` and ``types`` the words seen once and all words of every bucket.
    """

    def __init__(self, lexicon: Lexicon, classes: np.ndarray, head_class: np.ndarray, wide: np.ndarray, once: np.ndarray,
                 types: np.ndarray, train_tokens: int, vocabulary: int, ends: int, discount: float):
        n, start = lexicon.n_units, 1 + lexicon.n_units
        mass = once + discount * (types - once)
        total = (np.bincount(classes[:start], np.concatenate(([ends], lexicon.counts[:n])) + 0.5, CLASSES)
                 + wide[1] - discount * wide[0] + np.bincount(classes[start:], mass + 0.5, CLASSES))
        self.total = np.log10(np.maximum(total, 0.5))  # of a class; one without words is never used
        bucket = np.log10(mass + 0.5) - self.total[classes[start:]]
        safe = np.where(mass > 0, mass, 1.0)
        self.once = bucket + np.log10((1 - discount) / safe)
        # Unknown mass of a bucket; an empty bucket is all unknown.
        self.unknown = bucket + np.log10(np.where(mass > 0, discount * types, 1.0) / safe)
        taken = np.concatenate((lexicon.counts[:n] + 0.5, lexicon.counts[n:] - discount))
        self.head = np.log10(taken) - self.total[head_class]
        last = lexicon.repeated
        self.head[last:] = self.once[lexicon.unit[last:] - start]
        self.end = float(np.log10(ends + 0.5) - self.total[0])
        self.head_class, self.bucket_class = head_class.astype(np.uint8), classes[start:].astype(np.uint8)
        self.whole = math.log10(train_tokens + vocabulary + 1)
        self.base = np.log10(lexicon.counts + 1.0) - self.whole
        self.base_end, self.end_known = math.log10(ends + 1) - self.whole, ends > 0

    def emitted(self, codes: np.ndarray) -> tuple[int, float, float, np.ndarray]:
        """(known head tokens and end, base score, log10 P(words | classes), classes), without other words' scores."""
        seen, path = codes >= 0, np.empty(len(codes), np.uint8)
        head = codes[seen]
        path[seen], path[~seen] = self.head_class[head], self.bucket_class[-1 - codes[~seen]]
        return (len(head) + self.end_known, float(self.base[head].sum()) + self.base_end,
                float(self.head[head].sum()) + self.end, path)


def transitions(bigrams: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), drawn to the class unigrams."""
    n2 = bigrams.astype(float)
    share = (n2.sum(0) + 1.0) / (n2.sum() + CLASSES)
    return np.log10((n2 + PRIOR * share) / (n2.sum(1, keepdims=True) + PRIOR))


def _with_ends(path: bytes) -> np.ndarray:
    """Classes of a text between the end before and its own."""
    out = np.zeros(len(path) + 2, np.int64)
    out[1:-1] = np.frombuffer(path, np.uint8)
    return out


def path_bigrams(paths: DataFrame) -> np.ndarray:
    """Class bigrams of ``paths[path]``, at most CLASSES^2 rows a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            for path in b.column(0).to_pylist():
                c = _with_ends(path)
                total += np.bincount(c[:-1] * CLASSES + c[1:], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.record_batch({"k": pa.array(k.astype(np.int32)), "n": pa.array(total[k])})

    out = np.zeros(CLASSES * CLASSES, np.int64)
    for r in map_arrow(paths.select("path"), count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


def class_lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``[doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score]``, one row per input row."""
    sc = docs.sparkSession.sparkContext
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    counts = written(word_counts(src.where("not held_out")), "word-counts")
    ends = src.where("not held_out").count()

    # The frequent words: everything above a threshold that leaves at most HEAD of them.
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n"),
                                                            F.min("n").alias("least")).collect(), reverse=True)
    types = sum(r["types"] for r in levels)
    train_tokens, vocabulary = sum(r["n"] for r in levels) + ends, types + (ends > 0)
    least, taken = 1 << 62, 0
    for r in levels:
        taken += r["types"]
        if taken > HEAD:
            break
        least = r["least"]
    top = counts.where(F.col("n") >= least).select("word", "n").toArrow()  # at most HEAD rows
    lex = Lexicon(sorted(zip(top.column("word").to_pylist(), top.column("n").to_pylist()), key=lambda x: (-x[1], x[0])))
    lexicon = sc.broadcast(lex)
    del top
    once = {r["least"]: r["types"] for r in levels if r["least"] <= 2}
    n1, n2 = once.get(1, 0), once.get(2, 0)
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    table = written(encoded(src.select("doc_id", "text", "held_out"), lexicon), "encoded")
    tasks = max(sc.defaultParallelism, -(-train_tokens // ROUND_TOKENS))
    classes, after = clustered(table, lexicon, lex.size, tasks)
    wide = written(wide_classes(wide_counts(table, lexicon, classes), lex, classes, class_bigrams(after, classes)), "word-classes")

    # Classes of the broadcast words: at most HEAD rows.
    head_class = classes[lex.unit].astype(np.int64) if lex.words else np.zeros(0, np.int64)
    place = {w: i for i, w in enumerate(lex.words[lex.n_units:lex.repeated], lex.n_units)}
    found = wide.where(F.col("n") >= least).select("word", "class").toArrow()
    head_class[[place[w] for w in found.column("word").to_pylist()]] = found.column("class").to_numpy()
    by_class = np.zeros((2, CLASSES))
    for r in wide.groupBy("class").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect():
        by_class[:, r["class"]] = r["words"], r["tokens"]
    # Word types of every bucket: all words that are no units of their own.
    cut = (int(lex.counts[lex.n_units - 1]), lex.words[lex.n_units - 1]) if lex.n_units else (1 << 62, b"")
    outside = (F.col("n") < cut[0]) | ((F.col("n") == cut[0]) & (F.col("word") > F.lit(bytearray(cut[1]))))
    in_bucket = np.zeros((2, BUCKETS))
    for r in counts.where(outside).groupBy(_bucket("word").alias("b")).agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count(F.lit(1)).alias("types")).collect():
        in_bucket[:, r["b"]] = r["once"], r["types"]
    model = Scorer(lex, classes, head_class, by_class, *in_bucket, train_tokens, vocabulary, ends, discount)
    scorer = sc.broadcast(model)
    row = f"row long, doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, n_tokens long, known long, base double, score double"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = scorer.value
        for b in batches:
            found = [m.emitted(np.frombuffer(c, np.int32)) for c in b.column(3).to_pylist()]
            known, base, score, path = zip(*found) if found else ((), (), (), ())
            yield pa.record_batch({
                "row": b.column(0), "doc_id": b.column(1), "held_out": b.column(2),
                "n_tokens": pa.array([len(x) + 1 for x in path], pa.int64()), "known": pa.array(known, pa.int64()),
                "base": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
                "path": pa.array([x.tobytes() for x in path], pa.binary())})

    local = map_arrow(table.select("row", "doc_id", "held_out", "codes"), emit, row + ", path binary")
    unknown = F.broadcast(docs.sparkSession.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(model.once, model.unknown))],
        "b long, once double, unknown double"))  # BUCKETS rows
    # All words outside the lexicon; A word seen once has no class of its own.
    others = counts.where(F.col("n") < least).select("word", F.col("n").alias("c")).join(
        wide.where(F.col("n") < least).select("word", "class"), "word", "left")
    rare = (table.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.at", F.size("r.at").alias("k"))
                 .join(others, "word", "left").join(unknown, _bucket("word") == unknown["b"]))
    total = F.element_at(F.array(*[F.lit(float(x)) for x in model.total]), F.col("class") + 1)
    seen = F.col("c").isNotNull()
    added = rare.groupBy("row").agg(
        F.sum(F.when(seen, F.col("k")).otherwise(0)).alias("k_known"),
        F.sum(F.col("k") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - model.whole)).alias("k_base"),
        F.sum(F.col("k") * F.when(F.col("class").isNotNull(), F.log10(F.col("c") - discount) - total)
                            .when(seen, F.col("once")).otherwise(F.col("unknown"))).alias("k_score"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("at", "class"))).alias("spots"))

    def place_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = []
            for path, spots in zip(b.column(7).to_pylist(), b.column(8).to_pylist()):
                if spots:
                    path = np.frombuffer(path, np.uint8).copy()
                    for s in spots:
                        path[s["at"]] = s["class"]
                    path = path.tobytes()
                paths.append(path)
            yield pa.RecordBatch.from_arrays(b.columns[:7] + [pa.array(paths, pa.binary())], names=b.schema.names[:8])

    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = local.join(added, "row", "left").select(
        "row", "doc_id", "held_out", "n_tokens", (F.col("known") + zero("k_known")).alias("known"),
        (F.col("base") + zero("k_base")).alias("base"), (F.col("score") + zero("k_score")).alias("score"), "path", "spots")
    paths = written(map_arrow(joined, place_classes, row + ", path binary"), "paths")
    moves = sc.broadcast(transitions(path_bigrams(paths.where("not held_out"))))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        move = moves.value
        for b in batches:
            c = map(_with_ends, b.column(7).to_pylist())
            walked = np.array([move[x[:-1], x[1:]].sum() for x in c], float)
            score = pa.array(b.column(6).to_numpy() + walked)
            yield pa.RecordBatch.from_arrays(b.columns[:6] + [score], names=b.schema.names[:7])

    return map_arrow(paths, walk, row).select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
