"""Input columns that are named as the operators name their own come back as they were."""

import pytest
from cases import OWN_NAMES, documents, make

from scorefold.llm import dedup, mixing, quality, resemblance, simhash
from scorefold.llm.common import free


def good(docs):
    labels = docs.sparkSession.createDataFrame([(i, i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int")
    return quality.good_documents(docs, labels)


@pytest.mark.parametrize("stage", [good, dedup.without_copies, simhash.one_of_each, resemblance.one_of_each, mixing.mixed_documents])
@pytest.mark.parametrize("written", [False, True])
def test_own_names(spark, tmp_path, stage, written):
    docs = make(spark)
    if written:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    out = stage(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert 0 < len(rows) and (stage is mixing.mixed_documents or len(rows) <= len(documents()))
    assert all(r[c] == f"own {c}" for r in rows for c in OWN_NAMES)


def test_free(spark):
    docs = spark.createDataFrame([], "__row int, `___ROW` int")
    assert free("__row", docs) == "____row" and free("x", docs) == "x"
