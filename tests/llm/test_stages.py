"""Stages of the pipeline: columns they do not know, and the tables they leave behind."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import jaccard_join, staging
from keepwell.session import shared_folder
from keepwell.sources.files import SharedFiles

CLASHING = (
    "doc", "k", "_spans", "_rows", "_kept", "_quality", "_size", "_taken", "_copy", "_times", "a.b", "row", "ident", "id", "m",
    "digest", "_source", "_key", "words", "n", "source_size", "l", "e f", "ümlaut",
)


@pytest.fixture(scope="module")
def clashing(spark, docs):
    extra = [F.concat_ws("/", F.lit(name), F.col("doc_id").cast("string"), F.length("text")).alias(name) for name in CLASHING]
    return staging.stage(docs.drop("size", "key").select("*", *extra), "clashing")


@pytest.mark.parametrize("number", range(4))
def test_other_columns_come_back_unchanged(spark, clashing, number):
    name, function = corpus_pipeline.STAGES[number]
    out = function(spark, clashing, "")
    assert out.columns == clashing.columns and out.dtypes == clashing.dtypes
    quoted = [F.col(f"`{c}`") for c in CLASHING]
    before = {(r.doc_id, *r[1:]) for r in clashing.select("doc_id", *quoted).collect()}
    after = [(r.doc_id, *r[1:]) for r in out.select("doc_id", *quoted).collect()]
    assert after and set(after) <= before


def test_only_the_result_stays_in_the_shared_folder(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    files, folder = SharedFiles(spark), shared_folder(spark)
    before = set(files.names(folder))
    out = corpus_pipeline.run(spark, str(tmp_path))
    new = set(files.names(folder)) - before
    assert len(new) == 1 and new.pop().startswith("byte-level-BPE")
    assert out.count() > 0


def test_a_search_for_copies_leaves_one_table(spark, docs):
    files, folder = SharedFiles(spark), shared_folder(spark)
    before = set(files.names(folder))
    found = jaccard_join.near_duplicates(docs)
    assert len(set(files.names(folder)) - before) == 1 and found.count() == docs.count()


def test_tables_of_a_failed_block_go_too(spark):
    files, folder = SharedFiles(spark), shared_folder(spark)
    before = set(files.names(folder))
    with pytest.raises(ZeroDivisionError), staging.inner_tables(spark):
        staging.stage(spark.range(3), "lost")
        raise ZeroDivisionError
    assert set(files.names(folder)) == before


def test_sketches_bound_the_difference():
    """Never above the true difference, and well above a third of it for sets that share little."""
    draw = np.random.default_rng(4)
    for _ in range(400):
        n, m, shared = draw.integers(0, 400, 3)
        common = draw.integers(0, 2**63, shared).astype(np.uint64)
        a = np.unique(np.concatenate([common, draw.integers(0, 2**63, n).astype(np.uint64)]))
        b = np.unique(np.concatenate([common, draw.integers(0, 2**63, m).astype(np.uint64)]))
        true = len(np.setxor1d(a, b))
        bound = jaccard_join.least_difference(jaccard_join.sketch(a), jaccard_join.sketch(b))
        assert bound <= true and (true - bound) % 2 == 0
    assert jaccard_join.least_difference(jaccard_join.sketch(a[:300]), jaccard_join.sketch(a[:300])) == 0


def test_a_hot_class_and_a_hot_component(spark):
    """A third of the rows are one text, another third near copies of one; all find their least id."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, "same words again and again here", 0) for i in range(700, 1400)]
    rows += [(i, " ".join(base[:50] + [f"x{i}"] + base[50:]), 1) for i in range(2000, 2700)]
    rows += [(i, " ".join(f"y{i}z{j}" for j in range(10)), i) for i in range(3000, 3700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, g long").repartition(9)
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df).collect()}
    assert found == {i: {0: 700, 1: 2000}.get(g, i) for i, _, g in rows}
