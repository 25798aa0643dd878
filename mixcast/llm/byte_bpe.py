"""Operator 2: byte-level BPE encoding and decoding by monoid tree reduction.

Two levels, both folded as a balanced binary tree over halves of the input:

* **text**: halves of a long text are split into pattern matches, and neighbours are joined by splitting again a
  window of matches around the seam.  A match depends only on the text from its start on, and reads at most two
  characters beyond its end, so matches followed by two others are final, and all matches after a common boundary
  of both splits agree.  The window grows until it holds such a boundary.
* **match**: halves of a match are encoded, and neighbours are joined by merging again the bytes of a window of
  tokens around the seam.  A token sequence is the encoding of its bytes exactly when every adjacent pair of tokens
  is the encoding of its own bytes, so the window grows only until both its outer pairs hold.

Decoding concatenates the tokens' bytes up the same kind of tree.

Ids travel as a ``binary`` column of little-endian unsigned 32-bit integers.  The rank file (under 1 MB) is read
once on the driver and broadcast.  Null texts count as empty: no ids.  Rows are independent: repeated rows, ties
and columns of any other name pass through unchanged; an input column named like an output one is replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import Memo

SEGMENT = 1 << 15  # characters of a text's leaf
LEAF = 4           # bytes of a match's leaf
MEMO = 150_000     # remembered chunks per worker; memory only, never a limit on the results

# The classes of the split pattern below U+0250, spelled out (letters, numbers, white space).
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_LOW = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_HIGH = re.compile("[^\x00-ɏ]")
_RUN = re.compile(rf" [{_S}  -     　]")


class ByteBPE:
    def __init__(self, ranks: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.token = {r: t for t, r in self.rank.items()}
        self.any = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.halves = Memo(self._tree, MEMO)
        self.seams = Memo(lambda pair: self._merge(self.token[pair[0]] + self.token[pair[1]]), MEMO)
        self.matches = Memo(lambda m: self._pack(self.encode_match(m.encode())), MEMO)
        self.chunks = Memo(self._chunk, MEMO)

    @staticmethod
    def _pack(ids: tuple) -> bytes:
        return array("I", ids).tobytes()

    # -- one match ------------------------------------------------------------------------------------------
    def _merge(self, piece: bytes) -> tuple:
        """The merges of one window: lowest rank first, leftmost among equals."""
        return self._merge_short(piece) if len(piece) <= 24 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> tuple:
        get, none = self.rank.get, 1 << 40
        parts = [piece[i:i + 1] for i in range(len(piece))]
        near = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while near and (least := min(near)) < none:
            i = near.index(least)
            parts[i] += parts.pop(i + 1)
            del near[i]
            if i:
                near[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(near):
                near[i] = get(parts[i] + parts[i + 1], none)
        return tuple(map(get, parts))

    def _merge_long(self, piece: bytes) -> tuple:
        rank, n = self.rank, len(piece)
        end = list(range(1, n + 1))          # part i is piece[i:end[i]], -1: gone
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or mid >= stop or end[mid] != stop:
                continue
            end[i], end[mid] = stop, -1
            if stop < n:
                prev[stop] = i
                if (r := rank.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := rank.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        ids, i = [], 0
        while i < n:
            ids.append(rank[piece[i:end[i]]])
            i = end[i]
        return tuple(ids)

    def _join(self, a: tuple, b: tuple) -> tuple:
        pair = (a[-1], b[0])
        w = self.seams[pair]
        if w == pair:  # every adjacent pair holds already
            return a + b
        i = j = 1
        while True:
            left = i >= len(a) or self.seams[(pair := (a[-i - 1], w[0]))] == pair
            right = j >= len(b) or self.seams[(pair := (w[-1], b[j]))] == pair
            if left and right:
                return a[:max(0, len(a) - i)] + w + b[j:]
            i, j = (i if left else 2 * i), (j if right else 2 * j)
            w = self._merge(b"".join(map(self.token.__getitem__, a[-i:] + b[:j])))

    def _tree(self, piece: bytes) -> tuple:
        if len(piece) <= LEAF:
            return self._merge(piece)
        mid = len(piece) // 2
        a, b = piece[:mid], piece[mid:]
        return self._join(self.halves[a] if mid < 32 else self._tree(a), self.halves[b] if mid < 32 else self._tree(b))

    def encode_match(self, piece: bytes) -> tuple:
        known = self.rank.get(piece)
        return self._tree(piece) if known is None else (known,)

    # -- one text -------------------------------------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        return (self.any if _HIGH.search(text) else _LOW).findall(text)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a space and the chunk that follows it."""
        if chunk.isalpha() and not _HIGH.search(chunk):
            return self._pack(self.encode_match(f" {chunk}".encode()))
        return b"".join(map(self.matches.__getitem__, self.split(" " + chunk)))

    def _join_matches(self, a: list[str], b: list[str]) -> list[str]:
        if not a or not b:
            return a or b
        keep, take = max(0, len(a) - 3), 8
        head = "".join(a[keep:])
        while True:
            w = self.split(head + "".join(b[:take]))
            if take >= len(b):
                return a[:keep] + w
            ends, at = {}, len(head)
            for n, m in enumerate(b[:take], 1):
                at += len(m)
                ends[at] = n
            at = 0
            for n, m in enumerate(w[:-2], 1):
                at += len(m)
                if at in ends:
                    return a[:keep] + w[:n] + b[ends[at]:]
            take *= 2

    def _split_tree(self, text: str) -> list[str]:
        if len(text) <= SEGMENT:
            return self.split(text)
        mid = len(text) // 2
        return self._join_matches(self._split_tree(text[:mid]), self._split_tree(text[mid:]))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(text) > SEGMENT or _RUN.search(text):
            return b"".join(map(self.matches.__getitem__, self._split_tree(text)))
        # A space that no white space follows starts a match, so the chunks between spaces are independent.
        first, *rest = text.split(" ")
        return b"".join(map(self.matches.__getitem__, self.split(first))) + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: bytes | None) -> bytes:
        """Bytes of the ids; halves are concatenated up the tree."""
        if not ids:
            return b""
        if len(ids) > 4 * SEGMENT:
            mid = len(ids) // 8 * 4
            return self.decode(ids[:mid]) + self.decode(ids[mid:])
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


_CODECS: dict = {}


def _codec(shared, pattern: str) -> ByteBPE:
    key = (hash(shared.value), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = ByteBPE(shared.value, pattern)
    return _CODECS[key]


def _with(df: DataFrame, *fields: StructField) -> StructType:
    names = {f.name for f in fields}
    return StructType([f for f in df.schema.fields if f.name not in names] + list(fields))


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``n_tokens`` (long) and ``ids`` (binary); see the module for nulls and ties."""
    shared = _share(df, rank_path)
    kept = [c for c in df.columns if c not in {text, "ids", "n_tokens"}]
    src = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("ids"))
    schema = StructType([df.schema[c] for c in kept] + [StructField("n_tokens", LongType()), StructField("ids", BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared, pattern)
        for pdf in batches:
            ids = [codec.encode(t) for t in pdf["ids"]]
            pdf["n_tokens"], pdf["ids"] = [len(i) // 4 for i in ids], ids
            yield pdf

    return src.mapInPandas(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes of its ``ids`` column; null ids give no bytes."""
    shared = _share(df, rank_path)
    out = _with(df, StructField("decoded", BinaryType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared, pattern)
        for pdf in batches:
            pdf["decoded"] = [codec.decode(i) for i in pdf[ids]]
            yield pdf[out.names]

    return df.mapInPandas(run, out)


def _share(df: DataFrame, rank_path: str):
    with open(rank_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())
