"""The corpus pipeline: language, quality, near-duplicates, packing.

Each stage reads what its predecessor wrote and works on all of it. The first three return the columns of
``documents``: documents without a recognised language go, then those the quality model scores below its
threshold, then all but the smallest id of each class of near-duplicates (five-word shingles, similarity
0.8 or more). The last packs what is left into windows of 4096 tokens and returns a row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm import langid, neardup, packing, quality
from foldwise.llm.common import fold, kept, table
from foldwise.llm.queries import on_workers, vocabulary

MIN_LANGUAGE_SCORE = 0.5
OWN = {c: f"documents_{c}" for c in ("lang_pred", "score", "predicted")}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.withColumnsRenamed(OWN)  # the operator adds columns of these names
    out = langid.identify(named, fold("doc_id", 3) != 1).filter(f"lang_pred <> 'und' and score >= {MIN_LANGUAGE_SCORE}")
    return out.select(*named.columns).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2).select("doc_id", "quality")
    named = docs.withColumnsRenamed(OWN)  # the operator adds columns of these names
    out = quality.scored(named, quality.fit(docs, labels)).filter("predicted = 1")
    return out.select(*named.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenise(docs, vocabulary("word_bpe_49k.json"), with_ids=False))


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("packing", packed)]

#: Trained models and iterative classes have no SQL form; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(on_workers(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
