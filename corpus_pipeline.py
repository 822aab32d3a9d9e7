"""A corpus made ready for training, stage by stage.

Every stage gets what the one before has kept, as a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import jaccard_groups, mixing, packing, pseudonyms, quality_rules
from tillstream.llm.common import documents, materialize
from tillstream.llm.queries import PSEUDONYM_KEY


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return jaccard_groups.keep_one(docs)


def hide_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values give way to pseudonyms."""
    return pseudonyms.replace_in_place(docs, PSEUDONYM_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics get their weights."""
    return mixing.draw(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in windows of 1024."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("pseudonyms", hide_personal_values),
    ("source mixing", mix_sources),
    ("lexical packing", pack_windows),
]

#: SQL knows neither the tokenizer nor the fitted models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
