"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers A (byte-level BPE, ``tokenizers`` file) and B (SentencePiece model) encode
blank+text; B puts the blank in front itself. Every task encodes its batch through a
table of distinct words, so both end a token at every cut of that table, and turns ids into
byte ends. One NumPy state vector then holds the A and B pointers of all documents of the
batch: each step compares the two byte ends of every lane, emits a link and a cut
where they are equal, and moves the pointer that is behind (both at a link). Finished lanes
are compacted away. A long document takes several lanes of ``LANE_WORDS`` words, so a step
stays wide and the number of steps does not follow the longest document.

A link is a pair of token occurrences that end at the same byte; links cut the text into
groups. Links of an id pair are counted over the corpus: every task sums its own, one
shuffle adds them up. The ``frequent`` most frequent pairs, a fixed number, are broadcast
for scoring; links of all other pairs, none of which can be hot, get their counts by a
join, so the result is whole for any number of pairs.

Where words may be cut: at one blank between two characters that are neither white space
nor the marker U+2581. The pre-tokens of A and the pieces of B both end there (A's file
is checked for plain byte-level splitting, B's model as in ``sentence_pieces``); tokenizers
that fail that check encode whole texts.

Defined results: texts that are null or empty, or whose joined A or B bytes are not blank+text
(a text with U+2581, for example), have no tokens: zeros and the empty groups text. Special
strings in texts are plain text. Rows that repeat an id, or have none, each give a row and
count each time. An empty table gives no rows. A word without white space, however long,
is one lane.
"""
from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.bpe import _WS, byte_characters
from cohort.llm.common import groups, map_arrow, pick, written
from cohort.llm.sentence_pieces import MARK, piece_table

BATCH_CHARS = 1 << 20
CACHE_BYTES = 64 << 20
ENCODED_WORDS = 256  # words encoded in one go
ROWS = 512  # rows whose texts are Python strings at once
LANE_WORDS = 256
FREQUENT = 1 << 19  # pairs whose counts are broadcast, 17 bytes each
HELD_LINKS = 2 << 20  # links a task counts at once
_CUT = re.compile(f" (?<=[^{_WS}{MARK}] )(?=[^{_WS}{MARK}])")


class Numbers(dict):
    """Word -> number in order of first look-up; new words are noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def taken(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of ``pool`` laid end to end."""
    before = np.cumsum(counts) - counts
    return pool[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


class Side:
    """One tokenizer's ids of all numbered words, end to end."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], list[list[int]]], together: bool):
        """``encode`` gives the ids of blank+text; ``together`` if it is faster for words joined to one text."""
        self.tokens, self.encode, self.together = tokens, encode, together
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def add(self, words: list[str], spaced: set[str]) -> np.ndarray:
        """Append the words' ids; returns whether each word's tokens spell it.

        Words in ``spaced`` start or end with white space and are never encoded beside others.
        """
        found = [self._encoded(g, self.together and spaced.isdisjoint(g))
                 for g in (words[i:i + ENCODED_WORDS] for i in range(0, len(words), ENCODED_WORDS))]
        ids, counts, spelt = zip(*found)
        self.ids = np.concatenate((self.ids, *ids))
        self.counts = np.concatenate((self.counts, *counts))
        self.starts = np.cumsum(self.counts) - self.counts
        return np.concatenate(spelt)

    def _encoded(self, words: list[str], together: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, tokens of each word, whether they spell it) of a group of words.

        Joined words end where a token does, so byte ends give the words back.
        """
        text = " ".join(words)
        sizes = np.array(list(map(len, words) if text.isascii() else map(len, map(str.encode, words)))) + 1
        each = self.encode([text] if together else words)
        ids = np.fromiter(chain.from_iterable(each), np.uint32)
        ends = np.cumsum(self.length[ids])
        if b"".join(map(self.tokens.__getitem__, ids.tolist())) == b" " + text.encode():
            last = np.searchsorted(ends, np.cumsum(sizes))
            counts = np.diff(last + 1, prepend=0)
            if together or np.array_equal(counts, list(map(len, each))):
                return ids, counts, np.ones(len(words), bool)
        if together:
            return self._encoded(words, False)
        spelt = [b"".join(map(self.tokens.__getitem__, x)) == b" " + w.encode() for w, x in zip(words, each)]
        return ids, np.array(list(map(len, each)), np.int64), np.array(spelt)


class WordIds:
    """Ids of blank+word by both tokenizers, each distinct word encoded once per worker process."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        plain = (spec.get("normalizer") is None and split.get("type") == "ByteLevel"
                 and not split.get("add_prefix_space") and split.get("use_regex", True))
        tokenizer = Tokenizer.from_file(a_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        a_tokens: list[bytes] = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
            a_tokens[i] = bytes(byte_of[c] for c in token)
        pieces = piece_table(b_path)
        self.separable = plain and pieces.separable
        self.a = Side(a_tokens, lambda texts: [e.ids for e in tokenizer.encode_batch_fast(
            [" " + t for t in texts], add_special_tokens=False)], together=True)
        self.b = Side([t or b"" for t in pieces.tokens], lambda texts: pieces.model.encode(texts, num_threads=1),
                      together=False)
        self.clear()

    def clear(self) -> None:
        self.numbers, self.spelt, self.size = Numbers(), np.empty(0, bool), 0
        self.a.clear()
        self.b.clear()

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the words of ``texts`` noted as new. Only a text's first and last word can have outer white space."""
        new = self.numbers.new
        if not new:
            return
        spaced = {w for t in texts if t for w in (t[0], t[-1]) if w[0].isspace() or w[-1].isspace() or MARK in w[0] + w[-1]
                  or not self.separable}
        self.spelt = np.concatenate((self.spelt, self.a.add(new, spaced) & self.b.add(new, spaced)))
        self.size += sum(map(len, new)) + 220 * len(new)
        self.numbers.new = []

    def lanes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B, tokens of A and B per lane, and each lane's text.

        Texts whose tokens do not spell them have no lane.
        """
        if self.size > CACHE_BYTES:
            self.clear()
        words = [(_CUT.split(t) if self.separable else [t]) if t else [] for t in texts]
        sizes = np.array(list(map(len, words)), np.int64)
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        self.learn(words)
        owner = np.repeat(np.arange(len(texts)), sizes)
        wrong = np.unique(owner[~self.spelt[number]])
        if len(wrong):
            sizes[wrong] = 0
            fine = ~np.isin(owner, wrong)
            number, owner = number[fine], owner[fine]
        place = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first = np.flatnonzero(place % LANE_WORDS == 0)  # word that starts a lane
        a_count, b_count = self.a.counts[number], self.b.counts[number]
        if not len(first):
            return (np.empty(0, np.uint32),) * 2 + (np.empty(0, np.int64),) * 3
        return (taken(self.a.ids, self.a.starts[number], a_count), taken(self.b.ids, self.b.starts[number], b_count),
                np.add.reduceat(a_count, first), np.add.reduceat(b_count, first), owner[first])


def merge(a_ends: np.ndarray, b_ends: np.ndarray, a_count: np.ndarray, b_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all tokens that end together, in text order.

    ``a_ends`` and ``b_ends`` are byte ends over all lanes laid end to end; ``a_count`` and
    ``b_count`` are the tokens of each lane. Both sides of a lane cover the same bytes.
    """
    last = np.cumsum(a_count)
    p, q = last - a_count, np.cumsum(b_count) - b_count
    alive = np.flatnonzero(a_count > 0)
    p, q, last = p[alive], q[alive], last[alive]
    at_a, at_b = [], []
    while len(p):
        x, y = a_ends[p], b_ends[q]
        together = x == y
        at_a.append(p[together])
        at_b.append(q[together])
        p = p + (x <= y)
        q = q + (y <= x)
        going = p < last
        if not going.all():
            p, q, last = p[going], q[going], last[going]
    if not at_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Links in text order: both positions rise from link to link.
    a, b = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    a[np.concatenate(at_a)] = True
    b[np.concatenate(at_b)] = True
    return np.flatnonzero(a), np.flatnonzero(b)


class GroupWriter:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size = a_size
        self.after_a = np.array([f"{i}," for i in range(a_size)] + [f"{i}|" for i in range(a_size)], object)
        self.after_b = np.array([f"{i}," for i in range(b_size)] + [f"{i};" for i in range(b_size)], object)

    def write(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """Ids of one text and the positions of its links, the last of them on its last tokens."""
        if not len(a):
            return ""
        close_a, close_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        close_a[at_a] = 1
        close_b[at_b] = 1
        # B's tokens of earlier groups stand before an A token, A's tokens of the group before a B token.
        before_a = np.concatenate(([0], at_b + 1))[np.cumsum(close_a) - close_a]
        before_b = (at_a + 1)[np.cumsum(close_b) - close_b]
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + before_a] = self.after_a[a + close_a * (len(self.after_a) // 2)]
        out[np.arange(len(b)) + before_b] = self.after_b[b + close_b * (len(self.after_b) // 2)]
        return "".join(out.tolist())[:-1]


@lru_cache(maxsize=1)
def _tools(a_path: str, b_path: str) -> tuple[WordIds, GroupWriter]:
    ids = WordIds(a_path, b_path)
    return ids, GroupWriter(len(ids.a.tokens), len(ids.b.tokens))


def aligned_batch(texts: list[str | None], ids: WordIds, writer: GroupWriter) -> tuple[list[int], list[int], list[str], list[bytes]]:
    """Per text: tokens of A, tokens of B, groups, links as little-endian ``a << 32 | b``."""
    a, b, a_count, b_count, owner = ids.lanes(texts)
    at_a, at_b = merge(np.cumsum(ids.a.length[a]), np.cumsum(ids.b.length[b]), a_count, b_count)
    links = (a[at_a].astype("<u8") << np.uint64(32)) | b[at_b]
    n_a = np.bincount(owner, a_count, len(texts)).astype(np.int64)
    n_b = np.bincount(owner, b_count, len(texts)).astype(np.int64)
    end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
    cut = np.searchsorted(at_a, end_a)
    text, packed_links = [], []
    for ea, na, eb, nb, to, since in zip(end_a.tolist(), n_a.tolist(), end_b.tolist(), n_b.tolist(), cut.tolist(),
                                         [0] + cut.tolist()):
        text.append(writer.write(a[ea - na:ea], b[eb - nb:eb], at_a[since:to] - (ea - na), at_b[since:to] - (eb - nb)))
        packed_links.append(links[since:to].tobytes())
    return n_a.tolist(), n_b.tolist(), text, packed_links


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``[doc_id, n_a, n_b, n_links, groups, links]``, one row per input row.

    ``groups`` is text as in the module's writer (there are as many groups as links);
    ``links`` are little-endian 64-bit integers, A's id above B's, in text order. Narrow: no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, writer = _tools(a_path, b_path)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            texts = batch.column(1).to_pylist()
            for start, n in groups(texts, BATCH_CHARS):
                n_a, n_b, text, links = aligned_batch(texts[start:start + n], ids, writer)
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(start, n), "n_a": pa.array(n_a, pa.int64()),
                    "n_b": pa.array(n_b, pa.int64()), "n_links": pa.array([len(x) // 8 for x in links], pa.int64()),
                    "groups": pa.array(text, pa.string()), "links": pa.array(links, pa.binary())})

    src = pick(docs, doc_id=id_col, text=text_col)
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, n_a long, n_b long, n_links long, "
                               "groups string, links binary")


def _rows_of_links(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a binary column and the number of pairs of every row."""
    rows = [x or b"" for x in column.to_pylist()]
    return np.frombuffer(b"".join(rows), "<i8"), np.array([len(x) // 8 for x in rows], np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``[pair, b, n, best]``: links of every id pair, and whether no pair with that B id has more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held or [np.empty(0, "<i8")]), return_counts=True)
            return pa.record_batch({"pair": pa.array(pairs, pa.int64()), "n": pa.array(n, pa.int64())})

        for b in batches:
            for i in range(0, b.num_rows, 256):
                held.append(_rows_of_links(b.column(0).slice(i, 256))[0])
                size += len(held[-1])
                if size >= HELD_LINKS:
                    yield out()
                    held, size = [], 0
        yield out()

    n = map_arrow(aligned.select("links"), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = written(n.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))  # at most one row per id of B
    return n.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, counts: DataFrame, *, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` without ``links``, with ``n_best`` and ``count_sum`` of every row's links.

    ``counts`` is :func:`pair_counts` of the same table; both should be written tables, as they are
    read more than once. The ``frequent`` most frequent pairs are looked up in the tasks, all others joined.
    """
    spark = aligned.sparkSession
    top = counts.orderBy(F.col("n").desc(), "pair").limit(frequent).select("pair", "n", "best").toPandas()
    top = top.sort_values("pair")
    shared = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64),
                                           top["best"].to_numpy(bool)))
    kept = [c for c in aligned.columns if c != "links"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                b = batch.slice(i, 256)
                pairs, sizes = _rows_of_links(b.column(b.num_columns - 1))
                row = np.repeat(np.arange(b.num_rows), sizes)
                order = np.argsort(pairs)  # sorted look-ups stay in the processor's caches
                at = np.empty(len(pairs), np.int64)
                at[order] = np.minimum(np.searchsorted(known, pairs[order]), max(0, len(known) - 1))
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                at, of = at[hit], row[hit]
                sums = np.zeros(b.num_rows, np.int64)
                np.add.at(sums, of, n[at])
                bests = np.bincount(of[best[at]], minlength=b.num_rows)
                rest, start = pairs[~hit], np.searchsorted(row[~hit], np.arange(b.num_rows + 1))
                yield pa.record_batch(
                    [*b.columns[:-1], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(rest, pa.int64()))],
                    names=[*b.schema.names[:-1], "n_best", "count_sum", "rest"])

    plain = aligned.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)],
                           F.monotonically_increasing_id().alias("row"), "links")
    types = dict(plain.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in plain.columns[:-1])
    found = written(map_arrow(plain, look_up, f"{schema}, n_best long, count_sum long, rest array<long>"), "alignment")
    rest = (found.select("row", F.explode("rest").alias("pair")).join(counts, "pair")
            .groupBy("row").agg(F.count_if("best").alias("more_best"), F.sum("n").alias("more")))
    return (found.join(rest, "row", "left")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
                    (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum")))


def token_alignment(aligned: DataFrame, *, frequent: int = FREQUENT) -> DataFrame:
    """:func:`scored` over a table of :func:`align` (with any columns derived from it), written once."""
    table = written(aligned, "aligned")
    return scored(table, written(pair_counts(table), "pair-counts"), frequent=frequent)
