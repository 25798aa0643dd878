"""Operator 1: language identification by Bayesian evidence fusion.

For each row:  log P(lang | row) = text + declared + host prior + constant.

* text: tempered log-likelihood of the whole text under character-trigram models (hashed to ``CELLS`` cells).  Every
  language that ``MIN_TEXTS`` distinct texts declare gets one, counted on about ``sample`` of its texts (all, if it has
  no more).  A tag is dropped as noise if on texts held out its own model is best for less than ``OWN`` of them, and the
  model of a more frequent tag for more.
* declared: how often texts of a language declare this markup language, a confusion table over all rows.
* host prior: language counts of all rows by host, smoothed towards those of its registered domain, these towards
  those of its address suffix, and these towards all rows.  The counts are grouped sums of the texts' own best
  languages; tables are joined by key, so no host's rows are gathered.

A row is ``und`` and rejected if its text has no letters, fits a uniform model better than every language, or if no
language reaches ``min_confidence``.

Defined results: null and empty texts are ``und`` with confidence 0; a null declaration, host or address is no
evidence; ties go to the language first in alphabetical order; repeated rows get equal results; if no language is
declared anywhere every row is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

CELLS = 1 << 15
SAMPLE = 2000      # texts of each language that its trigram model is counted on (expected), those of the smallest hashes
MIN_TEXTS = 5      # distinct texts that make a model
OWN = 1 / 3        # of a tag's texts held out, the part that its own model must be best for
TEMPER = 0.25      # trigrams of a text overlap, so their evidence is not independent
SMOOTH = 20.0      # rows that a prior stands for at each level
MEMO = 6_500_000   # remembered numbers per worker, and at most 100,000 words; memory only
_LETTERS = re.compile(r"[^\d_]+")
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def trigrams(word: str) -> list[int]:
    """Cells of a word's character trigrams, with a mark at either end; none without letters or with digits inside."""
    w = _EDGE.sub("", word)
    if not w or not _LETTERS.fullmatch(w):
        return []
    w = f"^{w}$"
    return [xxhash.xxh64_intdigest(w[i:i + 3].encode()) & (CELLS - 1) for i in range(len(w) - 2)]


class TextModel:
    """Log-probabilities per cell and language; rows of words seen are remembered as one matrix."""

    def __init__(self, logp: np.ndarray):
        self.logp, self.rows, self.at = logp, np.zeros((1024, logp.shape[1] + 1)), {}
        self.most = min(100_000, MEMO // self.rows.shape[1])

    def _learn(self, words: list[str]) -> None:
        cells = [trigrams(w) for w in words]
        sizes = np.fromiter(map(len, cells), np.int64, len(cells))
        base, end = len(self.at), len(self.at) + len(words)
        if end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(end, len(self.rows)), self.rows.shape[1]))])
        self.at.update(zip(words, range(base, end)))
        self.rows[base:end] = 0
        self.rows[base:end, -1] = sizes
        some = np.flatnonzero(sizes)
        if len(some):
            flat = np.fromiter(chain.from_iterable(cells), np.int64, int(sizes.sum()))
            self.rows[base + some, :-1] = np.add.reduceat(
                self.logp[flat], (np.cumsum(sizes) - sizes)[some], axis=0, dtype=np.float64)

    def likelihood(self, text: str | None) -> tuple[np.ndarray, float]:
        """Log-likelihood under each language, and the number of trigrams."""
        words = (text or "").lower().split()
        if len(self.at) > self.most:
            self.at, self.rows = {}, self.rows[:1024] * 0
        at = self.at
        new = [w for w in dict.fromkeys(words) if w not in at]
        if new:
            self._learn(new)
        idx = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
        s = self.rows[idx].sum(axis=0) if len(idx) else np.zeros(self.rows.shape[1])
        return s[:-1], float(s[-1])


def fit_text(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their log-probabilities per cell from rows ``(text, declared)``."""
    known = rows.where(F.col("declared").isNotNull() & (F.length("text") > 0))
    hashed = known.select("text", "declared", F.xxhash64("text").alias("h"))
    seen = {r["declared"]: r["n"] for r in hashed.select("declared", "h").distinct().groupBy("declared")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TEXTS).collect()}  # a row per model
    langs = sorted(seen)
    if not langs:
        return [], np.full((CELLS, 1), -math.log(CELLS))
    order = {c: i for i, c in enumerate(langs)}
    ends = [(c, i, (1 << 63) - 1 if seen[c] <= sample else int(sample / seen[c] * 2.0 ** 64) - (1 << 63))
            for c, i in order.items()]
    ends = F.broadcast(rows.sparkSession.createDataFrame(ends, "declared string, lang int, end long"))
    half = F.pmod(F.xxhash64("h"), F.lit(2)).cast("int")
    picked = cut(hashed.join(ends, "declared").where(F.col("h") <= F.col("end")).groupBy("h", "lang")
                 .agg(F.first("text").alias("text")).select("lang", half.alias("half"), "text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (lang, part), texts in pdf.groupby(["lang", "half"])["text"]:
                n = Counter()
                for w, k in Counter(w for t in texts for w in t.lower().split()).items():
                    for x in trigrams(w):
                        n[x] += k
                yield pd.DataFrame({"lang": lang, "half": part, "cell": list(n), "n": list(n.values())}).astype(
                    {"cell": "int32", "n": "int64"})

    def model(n: np.ndarray) -> np.ndarray:
        return np.log((n + 0.02) / (n + 0.02).sum(axis=0)).astype(np.float32)

    c = picked.mapInPandas(count, "lang int, half int, cell int, n long").groupBy("lang", "half", "cell").agg(
        F.sum("n").alias("n")).toPandas()  # at most 2 * CELLS rows a language
    halves = np.zeros((2, CELLS, len(langs)))
    halves[c["half"], c["cell"], c["lang"]] = c["n"]
    shared = rows.sparkSession.sparkContext.broadcast([model(halves[1]), model(halves[0])])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [TextModel(x) for x in shared.value]  # each half under the model of the other
        for pdf in batches:
            found = [models[k].likelihood(t) for k, t in zip(pdf["half"], pdf["text"])]
            yield pd.DataFrame({"lang": pdf["lang"], "best": [int(f[0].argmax()) if f[1] else -1 for f in found]})

    best = np.zeros((len(langs), len(langs)))
    for r in (picked.mapInPandas(judge, "lang int, best int").where("best >= 0").groupBy("lang", "best")
              .agg(F.count(F.lit(1)).alias("n")).collect()):  # at most the square of the languages
        best[r["lang"], r["best"]] = r["n"]
    kept: list[int] = []
    for i in sorted(range(len(langs)), key=lambda i: (-seen[langs[i]], langs[i])):
        if best[i, i] >= OWN * best[i].sum() or not kept or best[i, kept].max() <= best[i, i]:
            kept.append(i)
    kept.sort()
    return [langs[i] for i in kept], model(halves.sum(axis=0)[:, kept])


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, registered domain (its last two labels) and address suffix (its last label) of a URL."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    return host, F.substring_index(host, ".", -2), F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def declared_language(html: Column) -> Column:
    """Primary subtag of the ``lang`` attribute of a page's ``html`` element, in lower case; null if there is none."""
    tag = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]{2,8})", 1))
    return F.when(tag != "", tag)


def page_text(html: Column) -> Column:
    """A page's text: without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[a-zA-Z#0-9]+;", " ")


def identify(rows: DataFrame, keys: list[str], sample: int = SAMPLE, min_confidence: float = 0.5,
             unknown: str | None = None) -> DataFrame:
    """``keys`` + ``(lang, confidence, text_lang, accepted)`` for rows with the columns ``text, declared, host, domain,
    suffix`` (all strings, any may be null).  A key named like a result is replaced by it.  ``unknown`` names a further
    column: whether the text has letters and declares a language without a model."""
    spark = rows.sparkSession
    langs, logp = fit_text(rows, sample)
    n_l = max(1, len(langs))
    shared = spark.sparkContext.broadcast(logp)  # CELLS numbers a language
    names = F.array(*[F.lit(c) for c in langs]) if langs else F.array(F.lit("und"))

    # the keys travel under names of their own, so that they may clash with the evidence
    own = [f"__key{i}" for i in range(len(keys))]
    slim = rows.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keys, own)], "declared", "host", "domain", "suffix", "text")
    schema = slim.drop("text").select("*", F.array(F.lit(0.0)).alias("ll"), F.lit(0.0).alias("grams")).schema

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = TextModel(shared.value)
        for pdf in batches:
            found = [model.likelihood(t) for t in pdf.pop("text")]
            pdf["ll"] = [f[0].tolist() for f in found]
            pdf["grams"] = [f[1] for f in found]
            yield pdf

    ev = cut(slim.mapInPandas(read, schema))
    clear = (F.col("grams") > 0) & (F.array_max("ll") >= F.col("grams") * math.log(1 / CELLS))
    best = F.array_position("ll", F.array_max("ll")) - 1
    votes = ev.where(clear).select("declared", "host", "domain", "suffix", best.cast("int").alias("best"))

    def counts(by: list[str]) -> DataFrame:
        n = (votes.where(F.col(by[0]).isNotNull()) if by else votes).groupBy(*by, "best").agg(
            F.count(F.lit(1)).cast("double").alias("k"))
        m = n.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("best", "k"))).alias("m"))  # a row a language
        return m.select(*by, F.transform(F.sequence(F.lit(0), F.lit(n_l - 1)),
                                         lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("n"))

    def smooth(n: str, prior: Column) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(n, prior, lambda x, p: (x + SMOOTH * p) / (total + SMOOTH))

    root = counts([]).first()
    every = [1.0 / n_l] * n_l if root is None or not any(root["n"]) else list(root["n"])
    top = [(x + 1) / (sum(every) + n_l) for x in every]
    top_c = F.array(*[F.lit(x) for x in top])
    suffixes = counts(["suffix"]).select("suffix", smooth("n", top_c).alias("ps"))
    domains = (counts(["domain", "suffix"]).join(suffixes, "suffix", "left")
               .select("domain", smooth("n", F.coalesce("ps", top_c)).alias("pd")).groupBy("domain")
               .agg(F.max("pd").alias("pd")))  # a domain has one suffix; max only names it
    hosts = (counts(["host", "domain"]).join(domains, "domain", "left")
             .select("host", smooth("n", F.coalesce("pd", top_c)).alias("ph")).groupBy("host").agg(F.max("ph").alias("ph")))
    tags = counts(["declared"]).select("declared", F.col("n").alias("nd"))
    joined = ev.join(hosts, "host", "left").join(tags, "declared", "left")
    # P(declared | lang), smoothed towards the tag's share of all rows
    tag_total = F.aggregate("nd", F.lit(0.0), lambda a, x: a + x)
    share = (tag_total + 1) / (sum(every) + 1)
    told = F.when(F.col("nd").isNull(), F.array(*[F.lit(0.0)] * n_l)).otherwise(
        F.zip_with("nd", F.array(*[F.lit(float(x)) for x in every]),
                   lambda x, t: F.log((x + SMOOTH * share) / (t + SMOOTH))))
    prior = F.coalesce("ph", top_c)
    log_post = F.zip_with(F.zip_with("ll", told, lambda a, b: a * TEMPER + b), prior, lambda a, p: a + F.log(p))
    alien = (F.col("grams") > 0) & F.col("declared").isNotNull() & ~F.array_contains(names, F.col("declared"))
    out = joined.select(*own, "ll", "grams", log_post.alias("lp"), F.coalesce(alien, F.lit(False)).alias("alien"))
    peak = F.array_max("lp")
    conf = 1 / F.aggregate("lp", F.lit(0.0), lambda a, x: a + F.exp(x - peak))
    out = out.select("*", clear.alias("clear"), conf.alias("conf"))
    ok = F.col("clear") & (F.col("conf") >= min_confidence) & F.lit(bool(langs))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keys, own) if c not in {"lang", "confidence", "text_lang", "accepted"}],
        F.when(ok, F.element_at(names, F.array_position("lp", peak).cast("int"))).otherwise("und").alias("lang"),
        F.when(F.col("clear") & F.lit(bool(langs)), F.col("conf")).otherwise(0.0).alias("confidence"),
        F.when(F.col("clear") & F.lit(bool(langs)), F.element_at(names, F.array_position("ll", F.array_max("ll")).cast("int")))
        .otherwise("und").alias("text_lang"),
        ok.alias("accepted"), *([F.col("alien").alias(unknown)] if unknown else []))


def document_rows(docs: DataFrame) -> DataFrame:
    """``documents`` as rows of evidence: the declared language is ``lang``, the host is ``source``."""
    none = F.lit(None).cast("string")
    return docs.select("*", F.col("lang").alias("declared"), F.col("source").alias("host"),
                       none.alias("domain"), none.alias("suffix"))


def page_rows(pages: DataFrame) -> DataFrame:
    """``pages`` as rows of evidence."""
    host, domain, suffix = host_parts(F.col("url"))
    return pages.select("*", page_text(F.col("html")).alias("text"), declared_language(F.col("html")).alias("declared"),
                        host.alias("host"), domain.alias("domain"), suffix.alias("suffix"))
