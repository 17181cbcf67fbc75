"""A corpus from raw documents to packed training sequences, as stages over Parquet."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import exact, jaccard, langid, mixing, packing
from lumenframe.llm.common import _remove, shared_dir
from lumenframe.llm.queries import tokenizer_path

#: A document whose best language is less sure than this is rejected.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those with a null text, without a letter or with a low
    score go. Rows repeat as they do in ``docs``; without labelled texts all documents go. Extra
    columns stay. An empty table stays empty."""
    found = langid.identify(docs, langid.train(docs))
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the most code points, then the
    smallest id, null last; of repeated rows one. Null and empty texts are one group. All columns
    stay as they are. An empty table stays empty."""
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8 or more): the one
    with the smallest id, null last; of repeated rows one. Null texts and those without words all
    stay. All columns stay as they are. An empty table stays empty."""
    return jaccard.keep_smallest(docs, k=5, least_percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to source targets takes them; one of a source may be cut to
    the words that its target still misses. Null is a source like others; null texts and those
    without words are never taken; repeated rows are taken as often as fits. Ties go by a seeded
    hash. All columns stay, n_chars too for the cut one. An empty table stays empty."""
    return mixing.mixed(docs, mixing.cycled_targets, F.array("source"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 2048 tokens. A null text is empty and
    gives its end token alone; repeated rows are packed each; extra columns are not read. An
    empty table gives no pieces."""
    return packing.pack(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The network, the seeded choice and the tokenizer have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again as the next one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        out.write.parquet(path)
        atexit.register(_remove, spark, path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
