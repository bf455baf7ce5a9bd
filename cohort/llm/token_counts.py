"""Token counts: batch encoding in Arrow functions that returns lengths only.

The tokenizer drops white space and merges only inside words, so a text's token
count is the sum over its ASCII-white-space-separated pieces. Each task gathers
documents into batches of about ``BATCH_BYTES``, cuts longer texts at white space,
encodes the batch's distinct unseen pieces in one ``encode_batch_fast`` call and
adds up lengths. No ids leave the task. The piece-length cache is bounded by bytes
and emptied when full, which changes speed only.

Why white space is a safe boundary for this vocabulary: the normaliser is NFC,
white space to one blank, lower-casing per character; a blank never composes with a
neighbour under NFC; the split pattern drops blanks and no token spans them. Only
ASCII white space is cut, so other Unicode spaces stay for the library to judge.

Defined results: null and empty texts have 0 bytes and 0 tokens; special strings
inside a text are handled as the library does by default; repeated rows each give a row.
"""
from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from cohort.llm.common import map_arrow, pick, sections

BATCH_BYTES = 4 << 20
CACHE_BYTES = 64 << 20
OVER_LIMIT = 2048


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    # One encoder thread per task: Spark already runs one task per core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class PieceLengths:
    """Token counts of white-space-free pieces, remembered up to ``CACHE_BYTES``."""

    def __init__(self, path: str):
        self.tokenizer, self.known, self.size = _tokenizer(path), {}, 0

    def learn(self, pieces: set[bytes]) -> None:
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        new = [p for p in pieces if p not in self.known]
        found = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        self.known.update(zip(new, (len(e) for e in found)))
        self.size += sum(map(len, new)) + 100 * len(new)

    def count(self, texts: list[bytes]) -> list[int]:
        """Token counts of ``texts`` (one batch)."""
        totals, group, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for part in sections(text):
                group.append((i, part.split()))
                held += len(part)
                if held >= BATCH_BYTES:
                    self._flush(group, totals)
                    group, held = [], 0
        self._flush(group, totals)
        return totals

    def _flush(self, group: list[tuple[int, list[bytes]]], totals: list[int]) -> None:
        pieces: set[bytes] = set()
        for _, p in group:
            pieces.update(p)
        self.learn(pieces)
        length = self.known.__getitem__
        for i, p in group:
            totals[i] += sum(map(length, p))


@lru_cache(maxsize=2)
def _lengths(path: str) -> PieceLengths:
    return PieceLengths(path)


def token_counts(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = OVER_LIMIT) -> DataFrame:
    """``[doc_id, n_bytes, n_tokens, over_limit]``, one row per input row.

    ``tokenizer_path`` must be readable at the same place on every executor (it comes
    with an installed package). Narrow: no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(tokenizer_path)
        for b in batches:
            texts = [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            n = lengths.count(texts)
            yield pa.record_batch({
                "doc_id": b.column(0), "n_bytes": pa.array(map(len, texts), pa.int64()),
                "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([k > limit for k in n], pa.bool_())})

    src = pick(docs, doc_id=id_col, text=text_col)
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean")
