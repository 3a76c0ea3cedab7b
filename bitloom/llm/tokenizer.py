"""Encoding and decoding with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: How the tokenizer cuts a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = 1 << 60
_PAIRS = 1_000_000  # entries of the pair table a worker keeps
_BLOCK = 8192  # bytes whose token matches are held at once
_REMEMBERED, _SHORT = 150_000, 48  # pieces a worker remembers, and how long one may be
_WHOLE = 1 << 20  # characters up to which the pieces of a text are listed at once
_SLICE = 4 << 20  # characters encoded before a batch is handed on


class Codec:
    """Exact BPE of one vocabulary by backtracking over longest matches.

    An Aho-Corasick automaton gives all tokens that start at a position. The
    encoder takes the longest that may follow the token before, and steps back
    where none may. Two tokens may follow each other if merging their joined
    bytes gives just the two (:meth:`may_follow`); a sequence in which all neighbours may is the
    BPE of its bytes, so each position is left for good at most once.
    """

    def __init__(self, vocabulary: bytes):
        import ahocorasick
        import regex

        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.tokens: list[bytes] = [b""] * (max(self.rank.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, i in self.rank.items():
            self.tokens[i] = token
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.tokens))
        self.cut = regex.compile(PATTERN)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.pieces = _Pieces(self)
        # offset table: token i is blob[offsets[i]:offsets[i + 1]]
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.offsets = np.cumsum([0, *map(len, self.tokens)])

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts a token is merged from: BPE of its bytes short of the last merge."""
        own, parts = self.rank[token], [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self.rank.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= own:
                raise ValueError(f"token {own} can't be reached by merging")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def _edge(self, i: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at the left (0) or right (1) edge of a token while it is merged, each with the rank at which it is used up."""
        known = self.edges[side].get(i)
        if known is None:
            part, until, rising = self.tokens[i], _NEVER, []
            while True:
                rising.append((part, until))
                if len(part) == 1:
                    break
                until = self.rank[part]
                part = self._halves(part)[side]
            known = self.edges[side][i] = rising[::-1]
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs occur.

        Merging runs by rank from left to right. The two tokens stand unless at some time
        the parts at their border merge before either is used up in its own token.
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        if len(self.pairs) > _PAIRS:
            self.pairs.clear()
        left, right, i, j, fits = self._edge(a, 1), self._edge(b, 0), 0, 0, True
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            joined = self.rank.get(x + y, _NEVER)
            if joined < x_until and joined <= y_until and joined != _NEVER:
                fits = False
                break
            if x_until == y_until == _NEVER:
                break
            # at one rank the left token's merge comes first
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        self.pairs[a, b] = fits
        return fits

    def _starts(self, text: str, block: int) -> list[list[int]]:
        """For each position of a block the tokens that start there, shortest first."""
        low, high = block * _BLOCK, min(len(text), (block + 1) * _BLOCK)
        starts: list[list[int]] = [[] for _ in range(high - low)]
        sizes = self.tokens
        for end, i in self.automaton.iter(text, low, min(len(text), high + self.longest)):
            at = end + 1 - len(sizes[i])
            if low <= at < high:
                starts[at - low].append(i)
        return starts

    def _blockwise(self, text: str):
        blocks: dict[int, list[list[int]]] = {}

        def at(pos: int) -> list[int]:
            if (b := pos // _BLOCK) not in blocks:
                if len(blocks) > 2:
                    blocks.clear()
                blocks[b] = self._starts(text, b)
            return blocks[b][pos % _BLOCK]

        return at

    def piece(self, data: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        whole = self.rank.get(data)
        if whole is not None:
            return (whole,)
        text, n = data.decode("latin-1"), len(data)
        at = self._starts(text, 0).__getitem__ if n <= _BLOCK else self._blockwise(text)
        dead = bytearray(n + 1)
        out: list[int] = []
        taken: list[int] = []
        pos, k = 0, len(at(0)) - 1
        while pos < n:
            here = at(pos)
            while k >= 0:
                t = here[k]
                end = pos + len(self.tokens[t])
                if not dead[end] and (not out or self.may_follow(out[-1], t)):
                    break
                k -= 1
            else:
                dead[pos] = 1
                t, k = out.pop(), taken.pop() - 1
                pos -= len(self.tokens[t])
                continue
            out.append(t)
            taken.append(k)
            pos = end
            if pos < n:
                k = len(at(pos)) - 1
        return tuple(out)

    def _cut(self, text: str):
        return self.cut.findall(text) if len(text) <= _WHOLE else (m.group() for m in self.cut.finditer(text))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text; none for an empty or null one."""
        if not text:
            return np.zeros(0, np.int32)
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, self._cut(text))), np.int32)

    def decode(self, ids) -> str:
        """The text of ids, gathered by the offset table; bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        upto = np.cumsum(sizes)
        if not len(ids):
            return ""
        at = np.arange(upto[-1]) + np.repeat(starts - upto + sizes, sizes)
        return self.blob[at].tobytes().decode("utf-8", "replace")


class _Pieces(dict):
    """Ids of pieces; short ones are remembered, within a bound."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.codec.piece(piece.encode())
        if len(piece) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


_codecs: dict[int, Codec] = {}


def codec_of(vocabulary: bytes) -> Codec:
    """The worker's codec of a vocabulary, built once."""
    key = hash(vocabulary)
    if key not in _codecs:
        _codecs[key] = Codec(vocabulary)
    return _codecs[key]


def shared_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """The vocabulary file (below 1 MB, whatever the data) for all executors."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches in slices of a bounded number of characters or ids (one row at least)."""
    for batch in batches:
        values = batch.column(column).to_pylist()
        low, held = 0, 0
        for i, v in enumerate(values):
            held += len(v) if v else 0
            if held >= _SLICE:
                yield batch.slice(low, i + 1 - low), values[low : i + 1]
                low, held = i + 1, 0
        if low < len(values):
            yield batch.slice(low), values[low:]


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids``: each text as the ids of the tokenizer, without special tokens.

    Null and empty texts give an empty list. A special token's string in a text is ordinary text.
    Rows are kept as they come, repeated and null keys too; other columns are
    dropped; an empty table gives none. Nothing is shuffled.
    """
    shared = shared_vocabulary(docs.sparkSession, vocabulary)

    def run(batches):
        codec = codec_of(shared.value)
        for batch, texts in _slices(batches, 1):
            ids = [codec.encode(t) for t in texts]
            offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], [key, "ids"])

    used = docs.select(key, text)
    return used.mapInArrow(run, f"`{key}` {used.dtypes[0][1]}, ids array<int>")


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens`` of each text; 0 for null and empty ones."""
    shared = shared_vocabulary(docs.sparkSession, vocabulary)

    def run(batches):
        codec = codec_of(shared.value)
        for batch, texts in _slices(batches, 1):
            sizes = pa.array([len(codec.encode(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes], [key, "n_tokens"])

    used = docs.select(key, text)
    return used.mapInArrow(run, f"`{key}` {used.dtypes[0][1]}, n_tokens bigint")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of each list of ids: empty for an empty list, null for a null one."""
    shared = shared_vocabulary(encoded.sparkSession, vocabulary)

    def run(batches):
        codec = codec_of(shared.value)
        for batch in batches:
            lists = batch.column(1)
            there, ends, flat = lists.is_valid().to_numpy(False), lists.offsets.to_numpy(), lists.values.to_numpy()
            texts = [codec.decode(flat[a:b]) if ok else None for ok, a, b in zip(there, ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    used = encoded.select(key, ids)
    return used.mapInArrow(run, f"`{key}` {used.dtypes[0][1]}, text string")
