"""Operator 9: best-fit-decreasing packing with certified bounds and exchanges between partitions.

1. Every text is tokenised whole; sequences longer than the capacity are cut into capacity-sized pieces.
2. Full pieces are sequences of their own.  The others are dealt to partitions of at most about ``PER_GROUP`` pieces and
   packed there by best-fit decreasing.  They are dealt in the order of their lengths, so that every partition has the
   same mixture of lengths and long pieces find the short ones that complement them.
3. Dual-feasible functions bound each partition's bin count from below.  A partition that meets its bound is
   certified and gives up the bins that waste more than its average bin; one with a gap gives up all its bins that
   have room.
4. The pieces given up are dealt anew and packed again; the exchange counts when it saves bins.  It repeats until the
   bound over the whole length histogram is met or ``PATIENCE`` differently dealt exchanges in succession save nothing.
   Each exchange that counts saves a bin, so it ends.

Only the number of a piece and its length are packed; the other columns are joined to the result by the number.

The tokenizer file is read once on the driver and broadcast (under 2 MB).  Chunks between white space are
independent under its split pattern, so their ids are remembered per worker.

Defined results: null and empty texts give the end id only; null ids and repeated rows are documents like any other
(each row has pieces of its own); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Memo, cut

PER_GROUP = 65_536  # pieces packed together: some MB of numbers
BLOCK = 8           # partitions whose pieces are put in order and dealt by one task
PATIENCE = 3        # differently dealt exchanges that must fail before the last packing stands
MEMO = 150_000    # remembered chunks and words per worker; memory only

# Unicode's white space, on which the tokenizer splits (Python's str.split knows four more); the
# letters below U+0180 in lower case; its split pattern over them; and the byte alphabet's printable ranges.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ODD = re.compile("[\x1c-\x1f]")
_HIGH = re.compile("[^\x00-\u012f\u0131-\u017f]")
_L, _N = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_L}{_N}]+")
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_alphabet() -> dict[int, str]:
    """How the byte-level step writes each byte: printable ones stand for themselves."""
    chars = {b: chr(b) for b in _PRINTABLE}
    return chars | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in chars)}


class WordBPE:
    """Ids of whole texts, as the tokenizer gives them without special tokens.

    Chunks between white space and the words in them are remembered.  Words of plain characters (below U+0180, which
    composition leaves alone and lower-casing maps one by one) are merged by a rank encoder over the same vocabulary:
    the end of a word is the byte 0xFF, which no UTF-8 text holds, and a token's id is its rank, as the ids were given
    in the order of the merges.  Other chunks go through the whole tokenizer.
    """

    def __init__(self, model: str):
        self.tok = Tokenizer.from_str(model)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(model)
        special = {t["content"] for t in spec["added_tokens"]}
        byte = {c: bytes([b]) for b, c in _byte_alphabet().items()}
        end = spec["model"]["end_of_word_suffix"]
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                last = token.endswith(end) and token != end
                ranks[b"".join(byte[c] for c in (token[:-len(end)] if last else token)) + b"\xff" * last] = i
        self.merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.words, self.chunks = Memo(self._word, MEMO), Memo(self._chunk, MEMO)

    def _word(self, word: str) -> bytes:
        return array("I", self.merge(word.encode() + b"\xff")).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and _HIGH.search(chunk):
            return array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()
        if chunk.isalpha():
            return self._word(chunk.lower())
        return b"".join(map(self.words.__getitem__, _WORD.findall(chunk.lower())))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.chunks.__getitem__, _SPACE.split(text) if _ODD.search(text) else text.split()))


_MODELS: dict = {}


def _model(shared) -> WordBPE:
    key = hash(shared.value)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = WordBPE(shared.value)
    return _MODELS[key]


def pieces(docs: DataFrame, id_col: str, tokenizer: str, text: str = "text", capacity: int = 4096, end_id: int = 1,
           with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: each document's ids and ``end_id``, cut at the capacity."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    tail, step = int(end_id).to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _model(shared)
        for pdf in batches:
            out = []
            for i, t in zip(pdf["id"].astype("Int64"), pdf["text"]):
                ids = encode(t) + tail
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    out.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ()))
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]).astype({"id": "Int64"})

    return src.mapInPandas(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and the fill of each bin; every item goes to the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, fill = 0, []  # bit r of open_: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = open_ >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_ ^= 1 << r
        else:
            r, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if r > size:
            room[r - size].append(b)
            open_ |= 1 << (r - size)
    return bins, offsets, fill


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """No packing of ``counts`` items of these lengths has fewer bins.

    The best of three families of dual-feasible functions: the identity, the rounding functions u^(k), and the
    threshold functions that count items over capacity - t as whole bins and drop those under t (every t).
    """
    if not counts.sum():
        return 0
    order = np.argsort(lengths)
    x, c = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    best = -(-int((x * c).sum()) // capacity)
    for k in range(1, 33):
        whole = ((k + 1) * x) % capacity == 0
        scaled = np.where(whole, k * x, ((k + 1) * x // capacity) * capacity)  # k * capacity * u(x)
        best = max(best, -(-int((scaled * c).sum()) // (k * capacity)))
    number, volume = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(x * c)])
    t = np.unique(np.concatenate([x[2 * x <= capacity], [0]]))
    low, high = np.searchsorted(x, t, "left"), np.searchsorted(x, capacity - t, "right")
    high = np.maximum(high, low)
    best_t = (number[-1] - number[high]) + -(-(volume[high] - volume[low]) // capacity)
    return max(best, int(best_t.max()))


def _pack_groups(items: DataFrame, number: int, capacity: int, per_group: int, turn: int) -> DataFrame:
    """``number`` rows of ``(row, length)`` packed in groups: plus ``round, grp, bin, offset`` and ``redo``, whether the
    bin is given up."""
    groups = max(1, -(-number // per_group))
    blocks = -(-groups // BLOCK)
    each = -(-groups // blocks)
    # the order in a block is total, so that a repeated task deals alike; the salt makes exchanges differ
    mixed = items.select("row", "length").repartition(blocks, F.xxhash64("row", F.lit(turn)))
    dealt = mixed.sortWithinPartitions("length", F.xxhash64("row", F.lit(turn)), "row").select(
        "row", "length", (F.spark_partition_id() * each + F.pmod(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
                                                                 F.lit(each))).alias("grp"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["length"].to_numpy(dtype=np.int64)
        bins, offsets, fill = best_fit_decreasing(sizes, capacity)
        waste = capacity - np.array(fill)
        gap = len(fill) > lower_bound(*np.unique(sizes, return_counts=True), capacity)
        redo = waste > (0 if gap else waste.mean())
        return pdf.assign(bin=bins, offset=offsets, redo=redo[bins], round=turn)

    return cut(dealt.groupBy("grp").applyInPandas(
        run, "row long, length long, grp long, bin long, offset long, redo boolean, round int"))


def _bins(packed: DataFrame) -> int:
    return packed.select("grp", "bin").distinct().count()


def pack(items: DataFrame, capacity: int = 4096, per_group: int = PER_GROUP) -> DataFrame:
    """``items`` (with ``length`` between 1 and ``capacity``) plus ``sequence_id`` and ``offset`` (long)."""
    cols = [F.col(f"`{c}`") for c in items.columns if c not in {"sequence_id", "offset"}]
    items = cut(items.select(*cols, F.monotonically_increasing_id().alias("__row")))
    whole = F.col("length") >= capacity
    loose = items.where(~whole).select(F.col("__row").alias("row"), F.col("length").cast("long").alias("length"))
    hist = loose.groupBy("length").count().toPandas()  # at most capacity - 1 rows
    bound = lower_bound(hist["length"].to_numpy(), hist["count"].to_numpy(), capacity)
    last = _pack_groups(loose, int(hist["count"].sum()), capacity, per_group, 1)
    used, settled, turn, failed = _bins(last), [], 1, 0
    while used > bound and failed < PATIENCE:
        turn += 1
        pool = last.where("redo")
        before = _bins(pool)
        again = _pack_groups(pool, pool.count(), capacity, per_group, turn)
        saved = before - _bins(again)
        if saved > 0:
            settled.append(last.where("not redo"))
            last, used, failed = again, used - saved, 0
        else:
            failed += 1
    for part in settled:
        last = last.unionByName(part)
    number = F.col("round").cast("long") * (1 << 56) + F.col("grp") * (1 << 20) + F.col("bin")
    placed = last.select(F.col("row").alias("__row"), number.alias("sequence_id"), "offset")
    return items.where(~whole).join(placed, "__row").select(*cols, "sequence_id", "offset").unionByName(
        items.where(whole).select(*cols, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
