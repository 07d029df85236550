"""From raw documents to token ids: classify, drop copies and near copies, mix the sources, encode.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All stages but the last return the columns of
their input.  Ids are taken to be unique but for repeated rows, which the second stage removes; null texts,
sources and languages pass as each operator defines.  An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trackweave.llm import bpe, exact_dedup, near_join, quality, source_mix
from trackweave.llm.common import table, written


#: Bytes of encoded pieces that a worker remembers: less than the operator's own default, as workers stay from stage to stage.
KEEP = 20_000_000


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest id stays."""
    return exact_dedup.keep_largest(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that with the least id."""
    return near_join.keep_one(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them; some not at all, none more than three times."""
    return source_mix.draw(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes they decode to, and the ids."""
    return bpe.encode_documents(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, keep_ids=True, keep=KEEP)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mix", mix),
    ("byte-level BPE", encode),
]

#: A trained classifier is not SQL; tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(spark, docs, f"stage{k}")
    return docs
