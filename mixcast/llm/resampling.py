"""Operator 11: importance resampling towards a target corpus, ranked by a distributed radix sort.

Features are all runs of 1 to ``longest`` words; a feature's bucket is the CRC-32 of its bytes modulo ``buckets``.  The
buckets of all documents and of all target texts are counted, and a bucket's gain is floor(1000 ln((t + 1)(S + buckets)
/ ((s + 1)(T + buckets)))).  A document's weight is the sum of its features' gains, taken from one array of ``buckets``
numbers; Gumbel noise drawn from the SHA-256 of seed and id makes the highest scores a weighted sample without
replacement.

The order (score down, id up) comes from a least-significant-digit radix sort: in each pass, rows stand in chunks by
their present position; a row's destination is the number of rows with a smaller digit, plus those of its digit in
earlier chunks, plus those before it in its chunk.  The counts by (digit, chunk) and their prefix sums give the first
two.  The digits cover the bits in which the keys differ at all.  Chunks are equal shares of the positions, so that no
score, id or digit gathers rows, however often it occurs.

Words are the runs of ``WORD`` in the UTF-8 bytes after lower-casing A-Z; texts are read whole.

Defined results: a null text has no words; a document without features weighs 0; documents with fewer than
``least_words`` words have a null rank, as those have that are not drawn; a null id draws its noise from the seed alone
and is ranked after all other ids; of rows repeated in score and id, any may come first; empty tables give an empty
result.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value of the contract; bytes of 0x80 and more only occur in other code points
DIGIT = 11       # bits of a digit
_SIGN = -(1 << 63)


def _features(longest: int, buckets: int):
    """A function from a text to its number of words and the buckets of its features."""
    find, code = re.compile(WORD).findall, zlib.crc32

    def of(text) -> tuple[int, np.ndarray]:
        words = find(text.encode("utf-8", "surrogatepass").lower()) if isinstance(text, str) else []
        got = [np.fromiter(map(code, words), np.uint32, len(words))]
        for n in range(2, longest + 1):
            runs = [code(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
            got.append(np.array(runs, np.uint32))
        return len(words), np.concatenate(got) % buckets

    return of


def coded(docs: DataFrame, id_col: str, text: str, longest: int, buckets: int, seed: int) -> DataFrame:
    """``(doc_id, words, n_features, noise, found)``: ``found`` holds the buckets of a document's features as bytes."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = _features(longest, buckets)
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["key"], pdf["text"]):
                words, found = of(t)
                rows.append((words, len(found), gumbel(seed, i), found.astype(kind).tobytes()))
            yield pdf[["doc_id"]].join(pd.DataFrame(rows, columns=["words", "n_features", "noise", "found"], index=pdf.index))

    kind = np.uint16 if buckets <= 1 << 16 else np.int32
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{id_col}`").cast("string").alias("key"),
                      F.col(f"`{text}`").alias("text"))
    return src.mapInPandas(read, "doc_id long, words long, n_features long, noise long, found binary")


def gumbel(seed: int, doc_id: str | None) -> int:
    """floor(1000 x Gumbel noise) drawn from the seed and the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id if isinstance(doc_id, str) else ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296)))


def _totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of every bucket over all rows of ``found``: ``buckets`` numbers, summed by key."""
    kind = np.uint16 if buckets <= 1 << 16 else np.int32

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in batches:
            for b in pdf["found"]:
                total += np.bincount(np.frombuffer(b, kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"k": at, "n": total[at]})

    out = np.zeros(buckets, np.int64)
    for k, n in rows.select("found").mapInPandas(count, "k long, n long").groupBy("k").agg(F.sum("n")).collect():
        out[k] = n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its counts in the documents and in the target."""
    size, s, t = len(docs), docs.astype(np.float64), target.astype(np.float64)
    odds = ((t + 1) * (s.sum() + size)) / ((s + 1) * (t.sum() + size))
    return np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)


def scored(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, words, n_features, weight, score)``."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.int32

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            weight = np.array([gain[np.frombuffer(b, kind)].sum() for b in pdf["found"]], np.int64)
            yield pdf[["doc_id", "words", "n_features"]].assign(weight=weight, score=weight + pdf["noise"])

    return found.mapInPandas(weigh, "doc_id long, words long, n_features long, weight long, score long")


def _digits(rows: DataFrame, keys: list[str]) -> list[Column]:
    """Digits, least significant first, of the unsigned keys (last key least), over the bits in which rows differ."""
    ends = rows.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.bit_or, F.bit_and)]).first()
    out = []
    for k in reversed(keys):
        differ = (ends[f"bit_or_{k}"] ^ ends[f"bit_and_{k}"]) & ((1 << 64) - 1) if ends[f"bit_or_{k}"] is not None else 0
        shift = 0
        while differ >> shift:
            shift += ((differ >> shift) & -(differ >> shift)).bit_length() - 1  # past bits that all rows share
            out.append(F.shiftrightunsigned(k, shift).bitwiseAND(F.lit((1 << DIGIT) - 1)))
            shift += DIGIT
    return out


def radix_rank(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``position`` (long, from 0) in the order of the unsigned 64-bit ``keys``, first key first.

    Stable counting-sort passes; the row count and one bit mask per key reach the driver.
    """
    rows = cut(rows.withColumn("__at", F.monotonically_increasing_id()))  # unique; dense after the first pass
    chunk = max(1024, min(1 << 17, 8 * math.isqrt(rows.count())))  # rows of a chunk: also many chunks of few rows
    digits = _digits(rows, keys) or [F.lit(0).cast("long")]
    for digit in digits:
        place = Window.partitionBy("__chunk", "__digit").orderBy("__at")
        rows = cut(rows.withColumn("__chunk", F.expr(f"__at div {chunk}")).withColumn("__digit", digit)
                   .repartition("__chunk").withColumn("__before", F.row_number().over(place) - 1))
        counts = rows.groupBy("__digit", "__chunk").agg(F.count(F.lit(1)).alias("__n"))
        earlier = Window.partitionBy("__digit").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
        smaller = Window.orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)
        base = (counts.groupBy("__digit").agg(F.sum("__n").alias("__n"))  # one row per digit: 2^DIGIT at most
                .select("__digit", F.coalesce(F.sum("__n").over(smaller), F.lit(0)).alias("__base")))
        offsets = (counts.withColumn("__off", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).join(F.broadcast(base), "__digit")
                   .select("__digit", "__chunk", (F.col("__off") + F.col("__base")).alias("__off")))
        rows = rows.join(offsets, ["__digit", "__chunk"]).withColumn("__at", F.col("__off") + F.col("__before")).drop(
            "__digit", "__chunk", "__before", "__off")
    return rows.withColumnRenamed("__at", "position")


def resample(docs: DataFrame, target: DataFrame, id_col: str, text: str = "text", target_text: str = "text", longest: int = 1,
             buckets: int = 10000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; rank 1 is the first drawn."""
    found = cut(coded(docs, id_col, text, longest, buckets, seed))
    aim = coded(target.select(F.lit(0).cast("long").alias("__id"), F.col(f"`{target_text}`").alias("__text")), "__id", "__text",
                longest, buckets, seed)
    rows = cut(scored(found, gains(_totals(found, buckets), _totals(aim, buckets))))
    enough = F.col("words") >= least_words
    top = rows.agg(F.max("score")).first()[0] or 0
    # unsigned keys that rise in the wanted order: distance to the top score, then null ids last, then the id
    fit = rows.where(enough).select("*", (F.lit(top) - F.col("score")).alias("__score"),
                                    F.col("doc_id").isNull().cast("long").alias("__none"),
                                    F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.lit(_SIGN)).alias("__id"))
    ranked = cut(radix_rank(fit, ["__score", "__none", "__id"]))
    drawn = percent * ranked.count() // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank.cast("long").alias("rank")).union(
        rows.where(~enough).select(*out, F.lit(None).cast("long").alias("rank")))
