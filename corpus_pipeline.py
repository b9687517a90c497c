"""A corpus pipeline: each stage applies one operator and hands on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import mixing, packing, pii, quality, simhash
from freshet.llm.common import read, written
from freshet.llm.queries import tokenizer

# Near duplicates: five words, similarity 0.8. The angle between two
# fingerprints of 256 bits is arccos(2s / (1 + s)) for sets of similarity s
# and like size, which is 39 bits at 0.8 with a spread of 6; the radius is four
# spreads wider. Tables follow the number of fingerprints, so that at any size
# 99 of 100 pairs at 0.8 meet in one. Fingerprints only name candidates: a pair
# is linked if its sets of distinct shingles are as similar as that.
RECALL = 0.99


def near_tables(rows: int) -> list[list[int]]:
    """The sampled bit positions in which near copies among so many fingerprints meet."""
    return simhash.tables_for(rows, bits=256, similarity=NEAR["similarity"], radius=NEAR["radius"], recall=RECALL)


NEAR = {
    "shingle": 5,
    "lanes": 4,
    "radius": 62,
    "tables": near_tables,
    "similarity": 0.8,
}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.cascade(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the least id."""
    return simhash.representatives(docs, **NEAR)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", drop_near_copies),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Digests of texts, sampled bit positions and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
