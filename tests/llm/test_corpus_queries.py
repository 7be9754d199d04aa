"""The corpus queries against their SQL, and the pipeline."""

import pytest
from cases import make, size
from compare import connect, difference

import __spark_entry__ as driver
import corpus_pipeline
from scorefold.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql()) and "pipeline" not in driver.oracle_sql()


def test_stages_by_hand(spark, sf_dir):
    """Each stage against plain rules over what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], sf_dir).cache())
    all_, good, single, far, mixed = ([r.asDict() for r in x.collect()] for x in kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    dropped = {r["doc_id"] for r in all_} - {r["doc_id"] for r in good}
    wrong = [i for i, q in labels.items() if (i in dropped) == (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)
    best = {}
    for r in good:
        key = "".join(r["text"].split(" ")).translate({i: None for i in range(9, 14)})
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in single) == sorted(i for _, i in best.values())
    from test_resemblance import brute_stays

    assert sorted(r["doc_id"] for r in far) == brute_stays([(r["doc_id"], r["text"]) for r in single])
    sizes = {r["source"]: 0 for r in far}
    for r in far:
        sizes[r["source"]] += size(r["text"])
    taken = dict.fromkeys(sizes, 0)
    for r in mixed:
        taken[r["source"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len(sizes)
    assert all(taken[s] <= 3 * sizes[s] for s in sizes)
    out = corpus_pipeline.STAGES[-1][1](spark, kept[-1], sf_dir).toPandas()
    assert out.groupby("row")["length"].sum().eq(out.groupby("row")["doc_tokens"].first()).all() and len(out["row"].unique()) == len(mixed)
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048


def test_run_and_odd_rows(spark, sf_dir, tmp_path):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", None), ("none", [])):
        docs = make(spark, rows)
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, f"{tmp_path}/{name}").columns == docs.columns
        n = corpus_pipeline.run(spark, f"{tmp_path}/{name}").count()
        assert (n > 0) == (name == "odd")
