"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are maximal runs of a-z, 0-9 and non-ASCII characters after A-Z is lowered.
A window is ``WIDTH`` consecutive words of a test item; an item with fewer words is
one window of its own length. Every task maps its documents' words to the ids of
benchmark words, rolls one 64-bit window hash over all words of an Arrow batch at
once, looks the hashes up in the sorted benchmark hashes, and compares word by word
before a hit counts. Documents never shuffle.

The broadcast is bounded: the benchmark's bytes are summed first and the items are
dealt into blocks of about ``BLOCK_BYTES``. One block is one pass. With more, the
passes follow each other over a written table, each adding its hits to the spans
already found, so any benchmark size works with the same memory.

Defined results: null, empty or word-free texts have no words and no hits; items
without words (null too) have no windows; a word counts once however many windows
cover it; repeated rows each give a row; repeated items count once per ``item_id``; windows
of items without an id hit words but name no item;
``items_sha256`` of no item is the hash of the empty string.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import groups, map_arrow, pick, written

WIDTH = 13
BLOCK_BYTES = 32 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
# Delimiters become blanks, A-Z is lowered, bytes from 0x80 stay: words are byte.split().
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
SPANS = "array<struct<first:int,last:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse mod 2**64, for i < n."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _codes(ids: np.ndarray) -> np.ndarray:
    """Spread word ids over 64 bits (splitmix64)."""
    z = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def rolled(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` consecutive ids."""
    n = len(ids)
    if n < width:
        return np.empty(0, np.uint64)
    size = 1 << max(12, int(n).bit_length())
    up, down = _powers(size)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_codes(ids) * up[:n], dtype=np.uint64)))
    return (total[width:] - total[:-width]) * down[:n - width + 1]


class Windows:
    """The windows of one block of test items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            k = min(width, len(ids))
            for i in range(len(ids) - k + 1 if k else 0):
                by_length.setdefault(k, {}).setdefault(tuple(ids[i:i + k]), set()).update(
                    () if item is None else (item,))
        self.lengths = []
        for k, found in sorted(by_length.items()):
            keys = np.array(list(found), dtype=np.int64).reshape(len(found), k)
            hashes = np.array([rolled(row, k)[0] for row in keys])
            order = np.argsort(hashes, kind="stable")
            items_of = list(found.values())
            # A small bitmap settles most look-ups before the sorted search.
            bits = 1 << max(16, (16 * len(found)).bit_length())
            seen = np.zeros(bits, bool)
            seen[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
            self.lengths.append((k, hashes[order], keys[order], [items_of[i] for i in order], seen))

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, width, items) of every verified window in ``ids``."""
        for k, hashes, keys, items, seen in self.lengths:
            h = rolled(ids, k)
            at = np.flatnonzero(seen[(h & np.uint64(len(seen) - 1)).astype(np.int64)])
            low, high = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            for i, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
                for j in range(a, b):  # several only if hashes collide
                    if np.array_equal(keys[j], ids[i:i + k]):
                        yield i, k, items[j]


def _scan(batch_words: list[list[bytes]], windows: Windows) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Per document: merged spans of hit words (last exclusive) and the items found."""
    get = windows.vocabulary.get
    # Documents are laid end to end with a separator id that no window holds.
    ids = np.fromiter(chain.from_iterable(chain(map(get, w, repeat(-1)), (-2,)) for w in batch_words), np.int64,
                      sum(map(len, batch_words)) + len(batch_words))
    starts = np.cumsum([0] + [len(w) + 1 for w in batch_words])
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in batch_words]
    for i, k, items in windows.find(ids):
        d = int(np.searchsorted(starts, i, "right")) - 1
        out[d][0].append((i - int(starts[d]), i - int(starts[d]) + k))
        out[d][1].update(items)
    return [(merge(s), items) for s, items in out]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


# The scan takes about this many characters at once, however many rows that is.
SCAN_CHARS = 4 << 20


def _pass(docs: DataFrame, items: list[tuple[str, str | None]], width: int, keep: list[str]) -> DataFrame:
    """One block of items over ``[doc_id, text, spans, items, ...]``; columns named in ``keep`` go through."""
    shared = docs.sparkSession.sparkContext.broadcast(Windows(items, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for b in batches:
            texts = b.column("text").to_pylist()
            for start, n in groups(texts, SCAN_CHARS):
                part = b.slice(start, n)
                batch_words = [words(t) for t in texts[start:start + n]]
                found = _scan(batch_words, windows)
                before = zip(part.column("spans").to_pylist(), part.column("items").to_pylist())
                both = [(merge(s + [(x["first"], x["last"]) for x in old or []]), sorted(i.union(named or [])))
                        for (s, i), (old, named) in zip(found, before)]
                yield pa.record_batch({k: part.column(k) for k in keep} | {
                    "n_words": pa.array(map(len, batch_words), pa.int64()),
                    "spans": pa.array([[{"first": x, "last": y} for x, y in s] for s, _ in both], span_type),
                    "items": pa.array([i for _, i in both], pa.list_(pa.string()))})

    kept = "".join(f"{k} {dict(docs.dtypes)[k]}, " for k in keep)
    return map_arrow(docs, run, f"{kept}n_words long, spans {SPANS}, items array<string>")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                       block_bytes: int = BLOCK_BYTES, carry: str | None = None) -> DataFrame:
    """``[doc_id, n_words, spans, items]``: word spans (last exclusive) inside test windows.

    A column named by ``carry`` goes through as ``row``.
    """
    src = pick(docs, doc_id=id_col, text=text_col, **({"row": carry} if carry else {}))
    keep = ["doc_id"] + ["row"] * bool(carry)
    src = src.withColumns({"spans": F.lit(None).cast(SPANS), "items": F.lit(None).cast("array<string>")})
    items = (pick(benchmark, item=item_col, text=item_text_col)
             .where("text is not null").withColumn("item", F.col("item").cast("string")))
    size = items.agg(F.sum(F.octet_length("text") + 50)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for b in range(blocks):
        part = [(r.item, r.text) for r in dealt.where(F.col("block") == b).select("item", "text").collect()]
        last = b + 1 == blocks
        found = _pass(src, part, width, keep if last else ["text", *keep])
        if not last:
            src = written(found, "contamination").drop("n_words")
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``[doc_id, n_words, n_hit, n_items, items, contaminated]`` (and ``row``), one row per input row.

    Contaminated: at least one hit word and at least one word in twenty is hit.
    """
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"])
    row = ["row"] if options.get("carry") else []
    return (contaminated_spans(docs, benchmark, **options)
            .select(*row, "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


