"""A training corpus from raw documents: the dealt stages over ``documents``, one written table each.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Every
stage sees all rows that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callinsight.llm import exact_dedup, packing, pii, quality, similar
from callinsight.llm.common import documents, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to these documents, rejects go."""
    return quality.good_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by pairs of similarity 0.8 or more, on sets of five words, the one with the
    smallest id stays. Pairs come from the trie of fingerprints, what it leaves from the prefixes of the sets."""
    return similar.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; every document stays."""
    return pii.masked(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed by source mixture; each with the CRC-32 of its token ids."""
    return packing.with_crc(packing.Packing().pack(docs))


STAGES = [
    ("quality", good_quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("personal data", personal_data),
    ("packing", sequences),
]
#: SQL has no fingerprints or model fits; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
