"""Operator 4: SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes.  Two fingerprints within ``max_bits`` bits differ in at most
``max_bits`` bytes, so they share at least ``8 - max_bits`` positional bytes: the guaranteed minimum of matches.
Tallying over single-byte postings would pair everything with everything (a posting holds 1/256 of all rows), so
the postings are kept per *set* of positions of that minimum size (28 sets of six bytes for two bits): a pair meets
in a posting exactly when its tally over the set is complete.  The full tally over all eight positions is then
counted per pair, pairs below the minimum go, and the rest are verified by their bit distance.

Only distinct fingerprints enter the index, so copies cost nothing there; a posting of six fixed bytes holds
fingerprints that differ in the other two bytes only.  Links become components in ``common``.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked like any other;
texts of fewer words than a shingle use the whole word sequence; repeated rows share a fingerprint and so a
component; rows with a null id take part, are returned, and never name a component (a component of null ids only
has a null name).  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut

SEED = 42
STEP = 1 << 16  # shingles whose bits are counted at once

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _words(text: str | None) -> list[bytes]:
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and the white space 0x20 and 0x09-0x0D
    return text.encode().lower().split() if text else []


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits; a bit is 1 if it is set in over half of the XXH64 values of the word shingles, repeats included."""
    words = _words(text)
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:n - 1]]
    stops = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    counts = np.zeros((8, 256), dtype=np.int64)
    for at in range(0, n, STEP):
        h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[at:at + STEP], stops[at:at + STEP])], dtype="<u8")
        for k, column in enumerate(h.view(np.uint8).reshape(-1, 8).T):
            counts[k] += np.bincount(column, minlength=256)
    ones = (counts @ _BITS).reshape(64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, th, fp)`` of every row: the id, a hash of the text and the fingerprint as a signed 64-bit integer."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(f"`{text}`").alias("th"),
                      F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["text"]], dtype=np.uint64).astype(np.int64)
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "th": pdf["th"], "fp": fp})

    return src.mapInPandas(run, "id long, th long, fp long")


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)``, a < b, between distinct values ``fp`` that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must lie between 0 and 7: some positional byte must be shared")
    masks = []
    for keep in combinations(range(8), 8 - max_bits):
        m = sum(0xFF << (8 * k) for k in keep)
        masks.append(m - (1 << 64) if m >> 63 else m)
    sets = F.array(*[F.struct(F.lit(i).cast("byte").alias("s"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                     for i, m in enumerate(masks)])
    postings = fps.select("fp", F.explode(sets).alias("p")).select("fp", "p.s", "p.k")
    a, b = postings.withColumnRenamed("fp", "a"), postings.withColumnRenamed("fp", "b")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum(F.when(apart.bitwiseAND(F.lit((0xFF << 8 * k) - ((1 << 64) if k == 7 else 0))) == 0, 1).otherwise(0)
                for k in range(8))
    return (a.join(b, ["s", "k"]).where((F.col("a") < F.col("b")) & (tally >= 8 - max_bits)
                                        & (F.bit_count(apart) <= max_bits)).select("a", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str, text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(id, th, fp, cluster, component)`` for every row of ``docs``; component: the smallest id reachable by links;
    cluster: a fingerprint that names the component whatever its ids."""
    rows = cut(fingerprints(docs, id_col, text, shingle))
    values = cut(rows.groupBy("fp").agg(F.min("id").alias("first")))
    found = connected_components(links(values.select("fp"), max_bits))
    named = values.join(found, values.fp == found.id, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("first").alias("component"))
    named = named.join(least, "c").select("fp", F.col("c").alias("cluster"), "component")
    return rows.join(named, "fp").select("id", "th", "fp", "cluster", "component")
