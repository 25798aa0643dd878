"""Operator 6: substring deduplication by sliding spans of consecutive sentences.

A text is cut, without loss, into units: sentences (up to a sentence end of any script in ``_ENDS`` or a line end), those
of more than ``UNIT_WORDS`` words cut again at places that their words choose (``cuts``), so that no unit is longer.
Words stand between white space; in scripts that write none between words (``_DENSE``), each character with the marks and
punctuation after it is a word to cut at, and counts as half a word of a span.  Every shortest run of
consecutive units that has at least ``min_units`` units and ``min_words`` words, taken forwards from each unit and
backwards to each unit, is a span.  Wherever a repeated passage starts and ends, also inside a sentence, its copies are
cut alike but for at most ``UNIT_WORDS`` words at either end; so with one unit to a span, of any passage of at least
``min_words + 2 * UNIT_WORDS`` words the rest between is fully covered by equal spans.  Spans are hashed (letter case
and white space do not count) and joined globally with the first occurrence of their hash; all units covered by a span
that is not the first of its hash are removed.

"First" orders occurrences by (id, hash of the text, unit).  Only hashes, ids and numbers are grouped: hashes of all
spans, places of those whose hash comes again.  A frequent span is reduced to its count and its first occurrence before
the shuffles, and the joins back are ones that Spark can split.

Defined results: null and empty texts have no unit and stay as they are; texts too short for a span stay whole; rows
repeated in id and text count as one document and get equal results; null ids come first in the order; a text whose
units all go becomes empty; an empty table gives an empty result.  Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, written

UNIT_WORDS = 13  # a longer sentence is cut once in any so many neighbouring places
MIN_UNITS = 1
MIN_WORDS = 24
FLUSH = 100_000  # spans held by a task before they are sent on
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+\Z")
_WORD = re.compile(r"\S+\s*")

# Fixed values.  Sentence ends: ASCII, Arabic question mark and full stop, Devanagari danda and double danda, Myanmar
# little section and section, Khmer khan, ideographic full stop, its halfwidth form, fullwidth exclamation and question
# mark.  Scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, Hiragana and Katakana, ideographs with
# their extensions and compatibility forms, halfwidth Katakana.
_ENDS = ".!?\u061f\u06d4\u0964\u0965\u104a\u104b\u17d4\u3002\uff61\uff01\uff1f"
_DENSE = ("\u0e00-\u0e7f\u0e80-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
          "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003134f")
_SENTENCE_ANY = re.compile(rf"[^{_ENDS}\n]*[{_ENDS}\n]+\s*|[^{_ENDS}\n]+\Z")
_HAS_DENSE = re.compile(f"[{_DENSE}]")
_WORD_DENSE = re.compile(rf"[{_DENSE}][^\w\s]*|[^\s{_DENSE}]+")
_SPACED_DENSE = re.compile(rf"(?:{_WORD_DENSE.pattern})\s*")


def cuts(words: list[str]) -> list[int]:
    """Places (numbers of words before them) at which a sentence of more than ``UNIT_WORDS`` words is cut.

    Winnowing: of any ``UNIT_WORDS`` neighbouring places inside the sentence, the last that follows a word of the least
    hash.  A window inside a passage chooses the same place in each copy, and one that reaches beyond the passage
    chooses none between the choices of the first and the last window inside.  No unit is longer than ``UNIT_WORDS``.
    """
    keys = list(map(xxhash.xxh64_intdigest, words[:-1]))
    out, end = [], UNIT_WORDS
    while end <= len(keys):  # the windows before ``end`` have chosen
        window = keys[end - UNIT_WORDS:end]
        least = min(window)
        at = end - 1 - window[::-1].index(least)
        out.append(at + 1)
        # the choice holds until a word of no greater hash comes or the window leaves it
        end += 1
        while end <= at + UNIT_WORDS and end <= len(keys):
            if keys[end - 1] <= least:
                break
            end += 1
    return out


def has_dense(text: str | None) -> bool:
    """Whether a text holds characters of scripts without spaces."""
    return bool(text) and not text.isascii() and _HAS_DENSE.search(text) is not None


def units(text: str | None) -> list[str]:
    """Pieces of a text whose concatenation is the text."""
    out, text = [], text or ""
    dense = has_dense(text)
    for s in (_SENTENCE if text.isascii() else _SENTENCE_ANY).findall(text):
        if dense and _HAS_DENSE.search(s):
            own, words = [w.lower() for w in _WORD_DENSE.findall(s)], _SPACED_DENSE.findall(s)
            if len(words) <= UNIT_WORDS:
                out.append(s)
                continue
        elif len(s) <= 2 * UNIT_WORDS or len(s.split(None, UNIT_WORDS)) <= UNIT_WORDS:
            out.append(s)
            continue
        else:
            own, words = s.lower().split(), _WORD.findall(s)
        lead = s[:len(s) - sum(map(len, words))]
        words[0] = lead + words[0]
        at = [0, *cuts(own), len(words)]
        out += ["".join(words[a:b]) for a, b in zip(at, at[1:])]
    return out


def marks(pieces: list[str], dense: bool) -> tuple[list[int], list[int], bytes]:
    """The units with words: their places, their numbers of half words, and 8 bytes of hash for each.  ``dense``: whether
    the text ``has_dense`` characters."""
    digest = xxhash.xxh64_digest
    words = [_WORD_DENSE.findall(p) for p in pieces] if dense else [p.split() for p in pieces]
    # units without words belong to no span of their own but may lie inside one
    at = [i for i, w in enumerate(words) if w]
    sizes = [2 * len(words[i]) for i in at]
    if dense:
        sizes = [n - sum(_HAS_DENSE.match(w) is not None for w in words[i]) for i, n in zip(at, sizes)]
    return at, sizes, b"".join([digest(" ".join(words[i]).lower()) for i in at])


def spans(pieces: list[str], min_units: int, min_words: int) -> list[tuple[int, int, int]]:
    """``(first unit, units, hash)`` of every shortest span, forwards and backwards."""
    return runs(*marks(pieces, any(map(has_dense, pieces))), min_units, min_words)


def runs(at: list[int], sizes: list[int], marks: bytes, min_units: int, min_words: int) -> list[tuple[int, int, int]]:
    """``spans`` of a text from its ``marks``."""
    if len(at) < min_units:
        return []
    total, least = [0], 2 * min_words
    for n in sizes:
        total.append(total[-1] + n)
    n, ends, end, last = len(at), set(), 0, -1
    for a in range(n):
        end = max(end, a + min_units)
        while end <= n and total[end] - total[a] < least:
            end += 1
        if end > n:
            break
        ends.add((a, end))
        last = a
    if last < 0:
        return []
    start = n
    for b in range(n, 0, -1):
        start = min(start, b - min_units)
        while start >= 0 and total[b] - total[start] < least:
            start -= 1
        if start < 0:
            break
        ends.add((start, b))
    num = xxhash.xxh64_intdigest
    return [(at[a], at[b - 1] - at[a] + 1, num(marks[8 * a:8 * b]) - (1 << 63)) for a, b in ends]


def cut_up(docs: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """``(id, th, units, at, sizes, marks)`` of every text, written: both passes over the spans read these arrays, some
    9 bytes per unit, instead of the texts.  th: hash of the text; ``at`` is empty where every unit has words."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(f"`{text}`").alias("th"),
                      F.col(f"`{text}`").alias("text")).where(F.length("text") > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf["text"]:
                pieces = units(t)
                at, sizes, hashes = marks(pieces, has_dense(t))
                rows.append((len(pieces), b"" if len(at) == len(pieces) else np.array(at, np.int32).tobytes(),
                             np.array(sizes, np.uint8).tobytes(), hashes))  # a unit has 2 * UNIT_WORDS half words at most
            yield pdf[["id", "th"]].join(pd.DataFrame(rows, columns=["units", "at", "sizes", "marks"], index=pdf.index)).astype(
                {"id": "Int64", "units": "int32"})

    return cut(src.mapInPandas(run, "id long, th long, units int, at binary, sizes binary, marks binary"))


def repeated_spans(told: DataFrame, min_units: int = MIN_UNITS, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, th, first, n)``: the spans that are not the first of their hash, from the rows of ``cut_up``."""
    def found(units_: int, at: bytes, sizes: bytes, hashes: bytes) -> list[tuple[int, int, int]]:
        places = np.frombuffer(at, np.int32).tolist() if at else range(units_ if sizes else 0)
        return runs(places, list(sizes), hashes, min_units, min_words)

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat = []
            for k, row in enumerate(zip(pdf["units"], pdf["at"], pdf["sizes"], pdf["marks"])):
                flat += [h for *_, h in found(*row)]
                if len(flat) >= FLUSH or k == len(pdf) - 1:
                    yield pd.DataFrame({"h": np.array(flat, np.int64)})
                    flat = []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, flat = [], []
            for k, row in enumerate(zip(pdf["units"], pdf["at"], pdf["sizes"], pdf["marks"])):
                own = found(*row)
                rows += [k] * len(own)
                flat += own
                if len(flat) >= FLUSH or k == len(pdf) - 1:
                    yield pd.DataFrame({
                        "id": pdf["id"].astype("Int64").take(rows).to_numpy(), "th": pdf["th"].take(rows).to_numpy(),
                        "first": [s[0] for s in flat], "n": [s[1] for s in flat], "h": [s[2] for s in flat],
                    }).astype({"id": "Int64", "first": "int32", "n": "int32"})
                    rows, flat = [], []

    # only hashes are counted over all spans, places are compared for the repeated ones; each side of a join is written,
    # so that the join has shuffles of its own on both sides and Spark can split a frequent hash
    many = cut(told.select("units", "at", "sizes", "marks").mapInPandas(hashes, "h long").groupBy("h")
               .agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h"))
    every = written(told.mapInPandas(run, "id long, th long, first int, n int, h long").join(many, "h"), "spans")
    where = F.struct("id", "th", "first")
    firsts = cut(every.groupBy("h").agg(F.min(where).alias("lo")))
    return every.join(firsts, "h").where(F.col("lo") < where).select("id", "th", "first", "n")


def deduplicate(docs: DataFrame, id_col: str, text: str = "text", min_units: int = MIN_UNITS,
                min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """``docs`` with the covered units removed from ``text``; ``counts`` adds ``units`` and ``removed_units`` (int)."""
    clash = {"units", "removed_units"} if counts else set()
    cols = [c for c in docs.columns if c not in clash]
    told = cut_up(docs, id_col, text)
    found = repeated_spans(told, min_units, min_words).select("id", "th", F.struct("first", "n").alias("s"), F.lit(0).alias("u"))
    if counts:
        found = found.union(told.select("id", "th", F.lit(None).cast(dict(found.dtypes)["s"]).alias("s"), F.col("units").alias("u")))
    gone = (found.groupBy("id", "th")
            .agg(F.collect_set("s").alias("__spans"), F.max("u").alias("__size"))  # at most two per unit of one document
            .select(F.col("id").alias("__id"), F.col("th").alias("__th"), "__spans", "__size"))
    own = [f"__c{i}" for i in range(len(cols))]
    left = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(cols, own)],
                       F.col(f"`{id_col}`").cast("long").alias("__i"), F.xxhash64(f"`{text}`").alias("__t"))
    joined = left.join(gone, left["__i"].eqNullSafe(gone["__id"]) & (left["__t"] == gone["__th"]), "left")
    body = own[cols.index(text)]
    some = joined.select(*own, F.col("__spans.first").alias("__firsts"), F.col("__spans.n").alias("__ns"),
                         F.coalesce("__size", F.lit(0)).alias("__size"))
    schema = some.select(*own, F.lit(0).alias("__u"), F.lit(0).alias("__r")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, removed = [], []
            for t, firsts, ns in zip(pdf[body], pdf.pop("__firsts"), pdf.pop("__ns")):
                out = set() if firsts is None else {k for a, n in zip(firsts, ns) for k in range(a, a + n)}
                texts.append("".join(p for k, p in enumerate(units(t)) if k not in out) if out else t)
                removed.append(len(out))
            pdf[body] = pd.Series(texts, index=pdf.index, dtype=object)
            pdf["__u"], pdf["__r"] = pdf.pop("__size"), removed
            yield pdf

    done = some.mapInPandas(run, schema)
    tail = [F.col("__u").alias("units"), F.col("__r").alias("removed_units")] if counts else []
    return done.select(*[F.col(o).alias(c) for c, o in zip(cols, own)], *tail)
