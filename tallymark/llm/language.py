"""Language identification by rank-order n-gram profiles (out-of-place distance).

A text's letters are lower-cased, everything else is a word boundary, and n-grams of one to three
characters are counted over the whole text. A language's profile is the ranked list of its most
frequent n-grams; so is a document's. The distance of a document to a language is the sum, over the
document's n-grams, of how far each is from its rank in the language's profile, or the profile's
length if it is missing. The nearest language wins, ties by its name.

Profiles are fitted on a bounded sample: about ``docs_per_lang`` labelled documents of each language,
chosen by a hash of the identifier (all of them, if there are fewer). Prediction covers all documents
and whole texts. Null text and text without a letter give ``und`` and score 0; with no labelled
document at all every text does. A null label is not learned from. Repeated rows are each predicted;
null identifiers are never held out and never sampled. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import ship_package, staged

UNKNOWN = "und"
PROFILE = 300
SHIFT = np.uint64(21)
#: Labels whose shares are broadcast at most, by a count.
FEW = 1_000_000

_FOLDED: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    if not _FOLDED:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _FOLDED.append(table)
    return _FOLDED[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the text's n-grams and their counts; a code packs up to three code points, a boundary is 1."""
    points = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = points > 0
    if not letter.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = np.r_[np.uint32(0), points, np.uint32(0)]
    keep = (points > 0) | np.r_[True, points[:-1] > 0]  # a run of others is one boundary
    one = np.where(points[keep] > 0, points[keep], 1).astype(np.uint64)
    two = one[:-1] << SHIFT | one[1:]
    three = two[:-1] << SHIFT | one[2:]
    return np.unique(np.concatenate([one[one > 1], two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes in order, ties by code."""
    if len(codes) > 4 * size:  # all that could be among the first, ties included
        least = np.partition(counts, -size)[-size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Language profiles as an index from a code to the languages that rank it."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.names, self.size = sorted(profiles), size
        codes = np.array([c for name in self.names for c in profiles[name]], np.uint64)
        lengths = [len(profiles[name]) for name in self.names]
        order = np.argsort(codes, kind="stable")
        self.languages = np.repeat(np.arange(len(self.names)), lengths)[order]
        self.ranks = np.concatenate([np.arange(n) for n in lengths])[order] if lengths else np.zeros(0, np.int64)
        self.codes, starts = np.unique(codes[order], return_index=True)
        #: One more code, for those in no profile.
        self.starts = np.r_[starts, len(codes), len(codes)]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and one less its distance as a share of the largest possible."""
        mine = ranked(*grams(text or ""), self.size)
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        n = self.starts[at + 1] - self.starts[at]
        held = np.repeat(self.starts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        nearer = self.size - np.abs(self.ranks[held] - np.repeat(np.arange(len(mine)), n))
        most = self.size * len(mine)
        apart = most - np.bincount(self.languages[held], nearer, len(self.names)).astype(np.int64)
        best = int(apart.argmin())
        return self.names[best], float(1 - apart[best] / most)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a task: counts of n-grams by language."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(grams(text or ""))
        for lang, found in by_lang.items():
            found = [*found, total.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))]
            codes, at = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            total[lang] = codes, np.bincount(at, np.concatenate([x[1] for x in found]), len(codes)).astype(np.int64)
    for lang, (codes, counts) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])


def fit_profiles(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 2000, size: int = PROFILE) -> Profiles:
    """Profiles from a sample of about docs_per_lang documents a language.

    What comes to the driver, and goes to each worker, is a count and ``size`` codes for each label that
    occurs, some 5 KB a language.
    """
    ship_package(labelled.sparkSession)
    slim = labelled.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and doc_id is not null")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shares = staged(slim.groupBy("lang").agg((F.lit(docs_per_lang) / F.count(F.lit(1))).alias("share")), "languages")
    side = F.broadcast(shares) if shares.count() <= FEW else shares
    sample = slim.join(side, "lang").where(spread < F.col("share")).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    rows = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("grams")).select("lang", "grams.gram").collect()
    return Profiles({r.lang: r.gram for r in rows}, size)


def language_of(text: Column, profiles: Profiles) -> Column:
    """struct(lang_pred, score) of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([profiles.predict(x) for x in batch], columns=["lang_pred", "score"])

    return run(text.cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold that is never learned from: crc32 of the identifier as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_language(docs: DataFrame, profiles: Profiles | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 2000) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Without profiles they are fitted on the other folds."""
    ship_package(docs.sparkSession)
    if profiles is None:
        profiles = fit_profiles(docs.where(~held_out(id_col)), id_col, text_col, lang_col, docs_per_lang)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), language_of(F.col(text_col), profiles).alias("found"))
    return slim.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known(docs: DataFrame, least_score: float, profiles: Profiles | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 2000) -> DataFrame:
    """The rows of a known language with at least this score, as they are; nothing is shuffled."""
    ship_package(docs.sparkSession)
    if profiles is None:
        profiles = fit_profiles(docs.where(~held_out(id_col)), id_col, text_col, lang_col, docs_per_lang)
    found = language_of(F.col(text_col), profiles)
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least_score))
