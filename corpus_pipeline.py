"""A corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of documents. Decisions are about
rows: equal identifiers and null ones do not tie rows together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.exact_dedup import first_documents
from tallymark.llm.language import keep_known
from tallymark.llm.mixing import mixed_documents
from tallymark.llm.packing import pack_sequences
from tallymark.llm.queries import vocabulary
from tallymark.llm.simhash import first_of_near_copies
from tallymark.session import staged

#: A text whose letters resemble no language's profile scores below this. Documents of check_s score 0.323 or
#: more; texts in five unlearned languages, random letters and base64 0.299 at most, the shorter the higher.
MIN_LANGUAGE_SCORE = 0.31
#: Near copies share at least this part of their sets of shingles of so many words.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know; those without letters or far from every profile go."""
    return keep_known(docs, MIN_LANGUAGE_SCORE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, whatever their identifiers."""
    return first_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest identifier."""
    return first_of_near_copies(docs, words=NEAR_WORDS, similarity=NEAR_SIMILARITY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the numbers that the sources' targets ask for."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences."""
    return pack_sequences(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies), ("mixing", mix), ("packing", pack)]

#: Fingerprints, out-of-place distances and packing have no SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
