"""BPE encoding and decoding by prefix-sharing trie traversal.

A byte-level BPE encoding has one last token for every prefix of a word, and the
encoding of a prefix is the encoding of what stands before its last token plus that
token. A token fits as the last one when it ends the prefix and the pair (last token
before it, token) is its own BPE encoding; exactly one fits. So one state per prefix, its last
token, suffices, and prefixes shared by words are computed once.

Each task gathers the distinct unseen words of a batch into a trie, kept front-coded
as a sorted list with common-prefix lengths. Walking the list is a depth-first
traversal: the stack holds the last-token states along the current path, a word
pushes only its nodes below the shared prefix, and its tokens are read off backwards.
Pair checks and finished words are remembered, both with a bound; a full memory is
emptied, which changes speed only.

Pre-tokenisation follows the vocabulary file: special strings first, then white-space
chunks by a plain pattern, whose distinct values the tokenizers library splits further.
Long texts are cut where one blank stands between two non-blanks, which no word spans.

Defined results: null and empty texts have no ids and decode to the empty text (null
stays distinguishable only in the input); decoding unknown ids raises; ids that do not
form UTF-8 decode with replacement characters, as the library does. Repeated rows each
give a row.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohort.llm.common import groups, map_arrow, pick

BATCH_CHARS = 6 << 20
CACHE_BYTES = 48 << 20
PAIRS = 1 << 18
# White space as the split pattern of the vocabulary counts it (Unicode White_Space).
_WS = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_CHUNKS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_CUT = re.compile(f"(?<=[^{_WS}]) (?=[^{_WS}])")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes, merge ranks and special strings of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        to_bytes = lambda s: bytes(byte_of[c] for c in s)
        self.ids = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: t for t, i in self.ids.items()}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        # Every ending of a token, with the token's id or -1: look-ups stop at the first miss.
        self.endings: dict[bytes, int] = {t[i:]: -1 for t in self.ids for i in range(1, len(t))}
        self.endings.update(self.ids)

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE by rank; only for pairs of tokens, which are short."""
        out = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(out) > 1:
            best = min(((self.merges[p], i) for i, p in enumerate(zip(out, out[1:])) if p in self.merges),
                       default=None)
            if best is None:
                break
            (_, new), i = best
            out[i:i + 2] = [new]
        return out


class TrieEncoder:
    """Word encodings through last-token states on a trie of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.vocabulary = Vocabulary(path)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.special = (re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")")
                        if self.vocabulary.special else None)
        tokens = self.vocabulary.tokens
        self.packed = {i: i.to_bytes(4, "little") for i in tokens}
        self.length = {i: len(t) for i, t in tokens.items()}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _fits(self, a: int, b: int) -> bool:
        """Whether tokens a, b (b alone for a = -1) encode their joined bytes; remembered by ``a << 32 | b``."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        v = self.vocabulary
        pair = [b] if a < 0 else [a, b]
        found = self.fits[a << 32 | b] = v.merge(b"".join(map(v.tokens.__getitem__, pair))) == pair
        return found

    def encode_words(self, words: list[bytes]) -> Iterator[bytes]:
        """Packed token ids of sorted distinct words, each trie node visited once."""
        ending, remembered, packed = self.vocabulary.endings.get, self.fits.get, self.packed
        length = self.length
        before, states = b"", [-1]  # states[d]: last token of the prefix of d bytes
        for word in words:
            shared, most = 0, min(len(before), len(word))
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(end - 1, -1, -1):
                    token = ending(word[start:end])
                    if token is None:
                        raise AssertionError("no last token fits")
                    if token >= 0:
                        fits = remembered(states[start] << 32 | token)
                        if fits or fits is None and self._fits(states[start], token):
                            states.append(token)
                            break
                else:
                    raise AssertionError("no last token fits")
            ids, at = [], len(word)
            while at:
                token = states[at]
                ids.append(packed[token])
                at -= length[token]
            ids.reverse()
            yield b"".join(ids)
            before = word

    def _split(self, chunk: str) -> list[bytes]:
        """Pre-tokens of a white-space chunk; plain words with closing marks need no library call."""
        core = chunk.rstrip(".,;:!?")
        plain = core[1:] if core[:1] == " " else core
        # Below U+0250 isalpha() is the letter class of every Unicode version.
        if plain.isalpha() and (plain.isascii() or max(plain) < "\u0250"):
            return [core.encode(), chunk[len(core):].encode()] if len(core) < len(chunk) else [core.encode()]
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.split(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Encode the unseen chunks into ``known`` as little-endian unsigned 32-bit ids."""
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        new = chunks.difference(self.known)
        parts = list(map(self._split, new))
        words = sorted({w for p in parts for w in p})
        ids = dict(zip(words, self.encode_words(words))).__getitem__
        found = [ids(p[0]) if len(p) == 1 else b"".join(map(ids, p)) for p in parts]
        self.known.update(zip(new, found))
        self.size += sum(map(len, new)) + sum(map(len, found)) + 150 * len(new)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text."""
        out: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[list[bytes], list[str]]] = []
        held = 0

        def flush() -> None:
            self.learn({c for _, chunks in group for c in chunks})
            for to, chunks in group:
                to.append(b"".join(map(self.known.__getitem__, chunks)))
            group.clear()

        for to, text in zip(out, texts):
            for i, piece in enumerate(self.special.split(text or "") if self.special else [text or ""]):
                if i % 2:
                    flush()
                    held = 0
                    to.append(np.array(self.vocabulary.special[piece], "<u4").tobytes())
                    continue
                for part in _parts(piece):
                    group.append((to, _CHUNKS.findall(part)))
                    held += len(part)
                    if held >= BATCH_CHARS:
                        flush()
                        held = 0
        flush()
        return [b"".join(x) for x in out]

    def forget(self) -> None:
        """Empty the memory, as at the end of a task: the worker process may serve other stages next."""
        self.known, self.size = {}, 0
        self.fits.clear()

    def decode(self, ids: bytes) -> str:
        tokens = self.vocabulary.tokens
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _parts(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > BATCH_CHARS:
        cut = _CUT.search(text, start + BATCH_CHARS)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process."""
    return TrieEncoder(path)


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``[doc_id, n_tokens, ids]`` and, if asked for, ``decoded`` (the text of those ids).

    ``ids`` are little-endian unsigned 32-bit integers in a binary column. Narrow: no
    shuffle; ``tokenizer_path`` must be readable on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for start, n in groups(texts, BATCH_CHARS):
                ids = enc.encode(texts[start:start + n])
                out = {"doc_id": b.column(0).slice(start, n),
                       "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["decoded"] = pa.array(map(enc.decode, ids), pa.string())
                yield pa.record_batch(out)
        enc.forget()

    src = pick(docs, doc_id=id_col, text=text_col)
    more = ", decoded string" if decoded else ""
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, n_tokens long, ids binary{more}")


def decode(encoded: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``[doc_id, text]`` from ids as :func:`encode` returns them; null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                yield pa.record_batch({"doc_id": part.column(0), "text": pa.array(
                    [None if x is None else enc.decode(x) for x in part.column(1).to_pylist()], pa.string())})

    src = pick(encoded, doc_id=id_col, ids=ids_col)
    return map_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, text string")
