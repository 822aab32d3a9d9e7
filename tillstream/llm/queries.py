"""The operators of this folder as queries over the tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    collocations,
    fingerprints,
    jaccard_groups,
    lm_scoring,
    merkle,
    mixing,
    packing,
    pseudonyms,
    quality_rules,
    secrets,
    sharding,
    token_blocks,
    toxicity,
)
from tillstream.llm.common import documents, materialize
from tillstream.llm.oracles import COLLOCATIONS, merkle_sql
from tillstream.session import work_dir


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, the base test and the rules' verdict of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    voted = materialize(quality_rules.with_votes(docs).drop("text"))
    judged = quality_rules.judge(voted, quality_rules.fit_rules(voted))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality_probability",
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, raked weight, probability and draw of every document."""
    # without the texts, so that they are read once
    placed = materialize(mixing.with_cells(documents(spark, sf_dir)).drop("text"))
    return mixing.mix(placed).select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
        "weight", "probability", "drawn",
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of poor quality and of toxicity of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.chain_scores(documents(spark, sf_dir).select("doc_id", "text"), labels).drop("text")


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the written files."""
    path = work_dir(spark, "token-blocks")
    token_blocks.write_documents(documents(spark, sf_dir), path)
    return token_blocks.read_documents(spark.read.schema(token_blocks.SEGMENTS).parquet(path))


def op6_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    return packing.pack_documents(documents(spark, sf_dir)).drop("ids")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with pseudonyms for personal values, and how many of each kind."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, PSEUDONYM_KEY)


def op8_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return jaccard_groups.components(documents(spark, sf_dir))


def op9_threshold_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited form, and their likeness."""
    return fingerprints.compare_edited(documents(spark, sf_dir))


def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, and its shard of seventeen."""
    return sharding.assign_shards(
        documents(spark, sf_dir), sharding.even_weights(16), sharding.even_weights(17)
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language with their counts."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and folded root of every document."""
    return merkle.manifest(documents(spark, sf_dir))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets in every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return secrets.find_secrets(docs).drop("text")


#: Stands for the secret that a deployment passes in.
PSEUDONYM_KEY = "corpus pseudonyms, key of the tests"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity_chain": op4_toxicity_chain,
    "op5_token_blocks": op5_token_blocks,
    "op6_lexical_packing": op6_lexical_packing,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_jaccard_groups": op8_jaccard_groups,
    "op9_threshold_sketches": op9_threshold_sketches,
    "op10_rendezvous_sharding": op10_rendezvous_sharding,
    "op11_collocations": op11_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op11_collocations": COLLOCATIONS,
    "op12_merkle_manifest": merkle_sql(),
    "op8_jaccard_groups": r"""
with recursive words as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) >= 5
           then list_distinct([array_to_string(w[i:i + 4], ' ')
                               for i in generate_series(1, len(w) - 4)])
         when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words),
shingles as (select doc_id, unnest(s) as shingle from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by all),
links as (
  select a, b from shared join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * c >= 80 * (len(x.s) + len(y.s) - c)),
edges as (select a, b from links union all select b, a from links),
reached as (
  select a, b from edges union select reached.a, edges.b from reached join edges on reached.b = edges.a),
least_of as (select a, min(b) as m from reached group by a)
select doc_id, cast(len(s) as bigint) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id
from sets left join least_of on a = doc_id""",
}
