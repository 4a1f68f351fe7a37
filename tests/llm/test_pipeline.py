"""The pipeline's stages: what goes, what stays, and their columns."""

import pathlib

import pytest

import __spark_entry__
import corpus_pipeline
from dumpscope.llm import decontaminate, jaccard, quality_rules
from dumpscope.llm.common import written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_DIR), name))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, steps):
    docs, ruled, classified, single, clean, packed = steps
    assert all(df.columns == docs.columns for df in steps[:-1])
    assert all(ids(b) <= ids(a) for a, b in zip(steps, steps[1:], strict=False))
    assert ids(ruled) == ids(quality_rules.judge(docs).filter("kept"))
    assert ids(single) == ids(jaccard.classes(classified, 5, 80).filter("doc_id = component_id"))
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert ids(single) - ids(clean) == ids(decontaminate.overlaps(single, benchmark))
    assert decontaminate.overlaps(clean, benchmark).count() == 0
    assert ids(packed) == ids(clean)


def test_labelled_documents(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    classified, ruled = ids(steps[2]), {r["doc_id"]: r for r in quality_rules.judge(steps[0]).collect()}
    for row in labels:
        if row["quality"] == 0:
            assert row["doc_id"] not in classified
        elif not ruled[row["doc_id"]]["base_failed"]:
            assert row["doc_id"] in classified


def test_classifier_learns_from_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = "crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0"
    good, junk = (docs.join(labels.filter(f"quality = {q}"), "doc_id", "left_semi") for q in (1, 0))
    # The rows to learn from have one class only here, of which a model of its own would keep, or reject, every document.
    for learnt, other in ((good, junk), (junk, good)):
        mixed = learnt.filter(f"NOT {held}").union(other.filter(held))
        assert other.filter(held).count() and ids(corpus_pipeline.classifier_stage(spark, mixed, SF_DIR)) == ids(mixed) & ids(good)


def test_run_and_registration(spark, steps):
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(steps[-1].collect())
    names = set(__spark_entry__.queries())
    assert {"pipeline"} < names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert pathlib.Path(corpus_pipeline.__file__).parent == pathlib.Path(__spark_entry__.__file__).parent


def test_clashing_extra_columns(spark):
    text = " ".join(f"word{k} and" for k in range(60))
    rows = [(1, text, 1, 1, "a"), (2, text, 2, 2, "b"), (None, None, None, 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dropped_id long, rejected_id long, leaked_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted(r["rejected_id"] for r in jaccard.keep_one(docs).collect()) == [1, 3]
    assert decontaminate.keep_clean(docs, none).count() == 3
    assert quality_rules.keep_good(docs).columns == docs.columns
