"""The corpus pipeline: quality, duplicates, mixture, packed sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hemicycle.llm import contentsort, fingerprints, hostrules, mixing, packing
from hemicycle.llm.common import documents
from hemicycle.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Every document that is left is read once at least, none more than twice as often as another.
MIX = mixing.Mix(max_epochs=2.0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, from hosts that pass."""
    return hostrules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return contentsort.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    return fingerprints.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of the sources reads them."""
    return mixing.mix_rows(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mix", mix),
    ("packing", pack),
]

#: Tokens are not SQL's business; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before has written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
