"""The training-text pipeline: each stage is written as Parquet and read back for the next.

toxicity -> lines -> near_duplicates -> secrets -> packing.  A stage takes
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import warnings

import public_tokenizers
from pyspark.sql import DataFrame, Observation, SparkSession

from postlake.llm import linededup, neardup, packing, secrets, toxicity
from postlake.llm.common import stored, table

observed: dict[str, Observation] = {}  # of the last run of a stage
ORACLE_SQL = None  # scores, fitted patterns and token ids are beyond SQL; tests/llm holds run() against brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words or more that occurred earlier are cut; all documents stay.

    Nulls and odd tables as in ``linededup.without_repeats``.
    """
    return linededup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8).

    Groups are found in the texts as they are and as they were in ``documents``: line dedup cuts
    near copies down to a few words, which resemble nothing any more.
    """
    return neardup.keep_first(docs, before=table(spark, sf_dir, "documents"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, are masked; all documents stay."""
    observed["secrets"] = Observation()
    return secrets.mask_documents(docs, refused=observed["secrets"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        if name == "secrets" and (cut := observed[name].get["n_refused"]):
            warnings.warn(f"secrets: {cut} unbroken runs in inflated streams were cut at {secrets.INFLATED_BYTES} bytes")
    return docs
