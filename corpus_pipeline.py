"""Corpus pipeline: documents -> quality filter -> near-dedup -> secret masking -> mix -> packing.

Every stage works on all rows that its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Between stages the rows are written as
Parquet in the shared checkpoint folder and read again.

Per stage, for odd input: null texts count as empty; repeated rows are scored, masked,
mixed and packed each, while near-dedup keeps one of them; empty tables pass through;
extra columns are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import minhash, mixing, packing, quality, secret_scan
from fleetlens.llm.common import load, stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the co-trained classifier rejects."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: the one with the smallest doc_id."""
    return minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret span by a mask."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the mix of sources asks for."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences: one row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL form: sampling hashes, fitted models and tokens are outside SQL. tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
