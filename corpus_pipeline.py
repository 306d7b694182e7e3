"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import langid, mixing, packing, simhash, substrings
from tidegate.llm.common import saved, table
from tidegate.llm.queries import tokenizer_path

#: Near-duplicates have SimHash fingerprints of four-word shingles at most four bits apart.
SHINGLE_WORDS, RADIUS = 4, 4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.known_language(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the least doc_id.

    Of rows that share that doc_id one stays; rows without a doc_id stay.
    """
    found = simhash.near_duplicates(spark, docs, SHINGLE_WORDS, RADIUS)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = saved(spark, kept, "kept")
    named = docs.filter(F.col("doc_id").isNotNull())
    first = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has are cut out."""
    return substrings.without_repeats(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target sizes by leaving out and repeating blocks of words."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(spark, docs, tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Language ID, near-dedup and packing have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
