"""Every operator and stage over odd rows and over no rows at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillstream.llm import (
    fingerprints,
    jaccard_groups,
    lm_scoring,
    mixing,
    packing,
    pseudonyms,
    quality_rules,
    sharding,
    token_blocks,
    toxicity,
)
from tillstream.session import work_dir


def _quality(docs):
    voted = quality_rules.with_votes(docs)
    return quality_rules.judge(voted, quality_rules.fit_rules(voted))


def _blocks(docs):
    path = work_dir(docs.sparkSession, "edge-blocks")
    token_blocks.write_documents(docs, path)
    segments = docs.sparkSession.read.schema(token_blocks.SEGMENTS).parquet(path)
    return token_blocks.read_documents(segments)


def _packed(docs):
    return packing.pack_documents(docs).filter("start = 0")


def _toxic(docs):
    labels = docs.select(
        "doc_id",
        F.when(F.col("doc_id") != 3, 1).alias("quality"),
        (F.col("doc_id") % 2).cast("int").alias("toxic"),
    )
    return toxicity.chain_scores(docs, labels)


OPERATORS = [
    _quality,
    lambda docs: mixing.mix(mixing.with_cells(docs)),
    lm_scoring.score_documents,
    _toxic,
    _blocks,
    _packed,
    lambda docs: pseudonyms.pseudonymize(docs, "key"),
    jaccard_groups.components,
    fingerprints.compare_edited,
    lambda docs: sharding.assign_shards(docs, sharding.even_weights(16), sharding.even_weights(17)),
]


@pytest.mark.parametrize("operator", OPERATORS)
def test_odd_rows_give_a_row_each(edge_rows, operator):
    found = operator(edge_rows).collect()
    assert len(found) == edge_rows.count()
    ids = sorted((row.doc_id for row in found), key=repr)
    assert ids == sorted((row.doc_id for row in edge_rows.collect()), key=repr)


@pytest.mark.parametrize("operator", OPERATORS)
def test_no_rows(no_rows, operator):
    assert operator(no_rows).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda stage: stage[0])
def test_stages(spark, edge_rows, no_rows, stage, sf_dir):
    name, function = stage
    out = function(spark, edge_rows, sf_dir)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == edge_rows.columns
        assert out.dtypes == edge_rows.dtypes
    assert out.count() > 0
    if name == "quality rules":
        # the only row with fifty words and few repeated ones among them, beside the long texts
        assert 8 in {row.doc_id for row in out.collect()} <= {5, 6, 8}
    assert function(spark, no_rows, sf_dir).collect() == []
