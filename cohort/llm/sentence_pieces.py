"""SentencePiece encoding and decoding through a table of distinct marked words.

A vocabulary whose pieces hold white-space markers only in front never merges across the
place where a marker follows another character. Texts are cut at those places; every word
keeps its markers. Each task holds a table of the distinct marked words it has met:
a batch's unseen words are segmented once, in one library call, and the ids of a text are
its words' table entries joined by position. The table is bounded by bytes and emptied
when full, which changes speed only. Nothing is shuffled.

The cut is used only if the model allows it, which is read from the model itself: identity
normalisation, a marker put in front of the text, white space neither merged nor dropped,
byte fallback, no user-defined pieces, and no piece with a marker after another
character. Any other model encodes whole texts by the library.

Decoding joins the pieces' bytes and drops the marker that encoding put in front. Ids that
a text cannot give (unknown or control ids inside, bytes that are not UTF-8, a byte
in front) go to the library's own decoder.

Defined results: null and empty texts have the begin and end ids only and decode to the
empty text; the marker character U+2581 inside a text counts as a blank, as in the library;
a text without white space, however long, is one word; repeated rows each give a
row; an empty table gives no rows; null ids decode to null.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohort.llm.common import groups, map_arrow, pick

BATCH_CHARS = 4 << 20
CACHE_BYTES = 96 << 20
MARK = "▁"
# A marker after another character starts a word; it is dropped here and put back in front by the library.
_CUT = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


def packed(ids: list[list[int]]) -> list[bytes]:
    """Every list as little-endian unsigned 32-bit integers."""
    ends = np.cumsum([0] + [len(x) for x in ids]) * 4
    data = np.fromiter(chain.from_iterable(ids), "<u4", count=int(ends[-1]) // 4).tobytes()
    at = ends.tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


class PieceTable:
    """A model and its table of segmented words, one per worker process."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        norm, train, kind = spec.normalizer_spec, spec.trainer_spec, proto.ModelProto.SentencePiece
        self.separable = (
            not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
            and norm.escape_whitespaces and train.byte_fallback and not train.treat_whitespace_as_suffix
            and not any(p.type == kind.USER_DEFINED or re.search(f"[^{MARK}]{MARK}", p.piece) for p in spec.pieces)
            and any(p.piece == MARK for p in spec.pieces))
        # Bytes of every piece; None for pieces that no text gives.
        self.tokens: list[bytes | None] = [
            p.piece.replace(MARK, " ").encode() if p.type == kind.NORMAL
            else bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else None for p in spec.pieces]
        self.bytes_in_front = frozenset(i for i, p in enumerate(spec.pieces) if p.type != kind.NORMAL)
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.model.bos_id(), self.model.eos_id()))
        # The library sees no text where a marked word is the marker alone.
        alone = np.array([self.model.piece_to_id(MARK)], "<u4").tobytes()
        self.fixed = {"": alone} if self.separable else {}
        self.known, self.size = dict(self.fixed), 0

    def segment(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts (or single words without their first marker) by the library."""
        return packed(self.model.encode(texts, num_threads=1))

    def learn(self, words: set[str]) -> None:
        """Segment the unseen words into ``known``."""
        if self.size > CACHE_BYTES:
            self.known, self.size = dict(self.fixed), 0
        new = list(words.difference(self.known))
        ids = self.segment(new)
        self.known.update(zip(new, ids))
        self.size += sum(map(len, new)) + sum(map(len, ids)) + 150 * len(new)

    def encode(self, texts: list[str | None], ends: bool = True) -> list[bytes]:
        """Ids of every text, with the begin and end ids if ``ends``."""
        begin, end = (self.begin, self.end) if ends else (b"", b"")
        if not self.separable:
            return [begin + x + end for x in self.segment([t or "" for t in texts])]
        out: list[bytes] = []
        for start, n in groups(texts, BATCH_CHARS):
            words = [_CUT.split(t) if t else [] for t in texts[start:start + n]]
            self.learn(set(chain.from_iterable(words)))
            ids = self.known.__getitem__
            out += [b"".join((begin, *map(ids, w), end)) for w in words]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids, as the library decodes them."""
        data = ids[len(self.begin):] if ids.startswith(self.begin) else ids
        data = data[:-len(self.end)] if len(data) % 4 == 0 and data[-len(self.end):] == self.end else data
        body = np.frombuffer(data, "<u4").tolist()
        if not body:
            return ""
        try:
            if self.separable and body[0] not in self.bytes_in_front:
                text = b"".join(map(self.tokens.__getitem__, body)).decode()
                return text[1:] if text[0] == " " else text
        except (TypeError, IndexError, UnicodeDecodeError):
            pass  # ids that no text gives
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One table per worker process."""
    return PieceTable(path)


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``[doc_id, n_tokens, ids]`` and, if asked for, ``decoded`` (the text of those ids).

    ``ids`` are little-endian unsigned 32-bit integers in a binary column, with the begin and
    end ids. Narrow: no shuffle; ``model_path`` must be readable on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model_path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for start, n in groups(texts, BATCH_CHARS):
                ids = table.encode(texts[start:start + n])
                out = {"doc_id": b.column(0).slice(start, n),
                       "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["decoded"] = pa.array(map(table.decode, ids), pa.string())
                yield pa.record_batch(out)

    src = pick(docs, doc_id=id_col, text=text_col)
    more = ", decoded string" if decoded else ""
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, n_tokens long, ids binary{more}")


def decode(encoded: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``[doc_id, text]`` from ids as :func:`encode` returns them; null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model_path)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                yield pa.record_batch({"doc_id": part.column(0), "text": pa.array(
                    [None if x is None else table.decode(x) for x in part.column(1).to_pylist()], pa.string())})

    src = pick(encoded, doc_id=id_col, ids=ids_col)
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, text string")
