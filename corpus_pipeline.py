"""From raw documents to token digests: quality rules, near duplicates, benchmark leaks, personal data, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. A stage's
result is written and reread as the next one's documents.

Cases, each as its operator states it: a null text is an empty one, which the quality rules reject (too few words); a text of any length is
taken whole. A null id is judged like any other by the rules on texts, but has no partner among near duplicates, so it stays
there. Of a group of near duplicates the row with the least id and text stays; rows that repeat both stay together and are judged
alike. Several texts under one id are rows of their own in every stage. An empty table gives an empty result; extra columns are
carried along untouched, whatever their names, up to the last stage, which returns the digests alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dosecast.llm import bpe, decontaminate, jaccard_join, pii, quality_rules
from dosecast.llm.common import table
from dosecast.llm.queries import trusted_ids
from dosecast.sources.staging import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, trusted_ids(spark, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("quality rules", good_documents),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("BPE", token_digests),
]

ORACLE_SQL = None  # hashes and token ids have no SQL form; tests/llm checks each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{i}")
    return docs
