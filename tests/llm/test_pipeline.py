import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from passagemill.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage gets and returns."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        found.append((name, docs))
    return dict(found)


def test_stages_keep_the_columns(stages):
    for name, rows in list(stages.items())[:-1]:
        assert rows.columns == stages["documents"].columns, name


def test_each_stage_gets_smaller_by_its_decisions(stages, spark):
    ids = {name: [row["doc_id"] for row in rows.select("doc_id").collect()] for name, rows in stages.items()}
    assert set(ids["quality_rules"]) < set(ids["documents"])
    assert set(ids["toxicity"]) <= set(ids["quality_rules"])
    assert set(ids["near_duplicates"]) < set(ids["toxicity"]) or len(ids["toxicity"]) == len(set(ids["toxicity"]))
    assert set(ids["source_mixing"]) <= set(ids["near_duplicates"])
    assert set(ids["packing"]) == set(ids["source_mixing"])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = {row["doc_id"] for row in labels.where("quality = 1 and toxic = 0").collect()}
    documents = stages["documents"].where(F.size(F.split("text", r"\s+")) >= 60)
    long_clean = clean & {row["doc_id"] for row in documents.collect()}
    kept = len(long_clean & set(ids["quality_rules"])) / len(long_clean)
    assert kept > 0.95


def test_stages_on_edges(spark, edge_docs, no_docs, folder):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    for docs, least in ((edge_docs, 1), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
            assert docs.count() >= least


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "toxicity", "near_duplicates", "source_mixing", "packing"
    ]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    from checks.compare import connect, differences

    count, extra, missing = differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name])
    assert count == (50 if name.startswith("op11_") else 200) and not extra and not missing


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_a_row_for_each_input_row(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    key = {"op4": "page_id", "op12": "vec_id"}.get(name.split("_")[0], "doc_id")
    want = {"page_id": 50, "vec_id": 500, "doc_id": 200}[key]
    assert rows.select(key).distinct().count() == want
