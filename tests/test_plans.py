"""The physical plans that matter at scale."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["vector_topk_cosine", "keyword_topk", "rerank_overlap", "rag_answer", "apply_changes", "eval_rows"],
)
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_search_leaves_the_base_where_it_is(spark):
    text = plan(QUERIES["vector_topk_cosine"](spark, SF_DIR))
    assert "CoGroups" not in text and "label" not in text  # only id and vector are read
    scan = text.index("MapInArrow")
    assert "WindowGroupLimit" in text[:scan] and "Partial" in text[:scan]  # cut before the shuffle
    assert "Exchange" not in text[scan:]


def test_keyword_search_leaves_the_texts_where_they_are(spark):
    text = plan(QUERIES["keyword_topk"](spark, SF_DIR))
    assert "CoGroups" not in text and "Exchange" not in text[text.index("MapInArrow") :]


def test_large_search_limits_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr("passagemill.operators.topk.BROADCAST_BYTES", -1)
    text = plan(QUERIES["vector_topk_cosine"](spark, SF_DIR))
    groups = text.index("FlatMapCoGroupsInArrow")
    assert "WindowGroupLimit" in text[:groups] and "Partial" in text[:groups]


def test_index_search_reads_only_its_cells_also_after_syncs(spark, folder):
    from passagemill.operators.changes import diff_snapshots
    from passagemill.operators.index import build_index, vector_topk_indexed
    from passagemill.streaming.sync import apply_to_index

    def rows(n, word):
        place = F.array(F.col("id") % 10, F.col("id") / 1000, F.lit(1.0)).cast("array<float>")
        return spark.range(n).select("id", F.concat(F.lit(word), "id").alias("content"), place.alias("embedding"))

    index = build_index(rows(200, "a"), folder, dim=3, centroids=np.array([[c, 0.1, 1] for c in range(10)], dtype=float))
    for version in (1, 2, 3):
        old, new = (rows(200 + at, "ab"[at % 2]).where(f"id % 10 < {3 + at}") for at in (version - 1, version))
        apply_to_index(spark, index, diff_snapshots(old, new, "id", version))
    asked = spark.createDataFrame([(1, [2.0, 0.1, 1.0]), (2, [7.0, 0.1, 1.0])], "query_id int, embedding array<float>")
    found = vector_topk_indexed(asked, index, ("hashing", 3), 4, 1, "l2")
    text = plan(found)
    scan = text.index("MapInArrow")
    assert "Aggregate" not in text[scan:] and "content" not in text
    # the only exchange below the scan is the broadcast of replaced keys
    assert text[scan:].count("Exchange") == text[scan:].count("BroadcastExchange") > 0
    read = [path for path in found.inputFiles() if "/rows/" in path]
    assert {path.split("cell=")[1].split("/")[0] for path in read} == {"2", "7"}
    assert {row["id"] % 10 for row in found.collect()} == {2, 7}


def test_chunking_stays_in_one_stage_without_python(spark):
    from passagemill.operators.chunk import chunk_sentences, chunk_windows

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    for chunked in (chunk_sentences(docs), chunk_windows(docs)):
        text = plan(chunked)
        assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_wide_columns_are_joined_by_broadcast_of_small_hits(spark):
    from passagemill.operators.vector_search import with_columns

    base = spark.range(1000).select("id", F.repeat(F.lit("x"), 1000).alias("content"))
    hits = spark.createDataFrame([(1, 1, 5, 0.5)], "query_id int, rank long, id long, score double")
    joined = with_columns(hits, base, ["content"])
    assert "BroadcastHashJoin" in plan(joined) and joined.count() == 1


def test_counts_aggregate_before_the_shuffle(spark):
    text = plan(QUERIES["count_by_location"](spark, SF_DIR))
    assert "partial_count" in text
    assert "c_name" not in text


def test_python_steps_run_once(spark):
    from passagemill.operators.embed import check_vectors, hash_embed

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    vectors = hash_embed(docs.repartition(4, "doc_id"), "text")
    for df in (
        vectors.select("doc_id", F.posexplode("embedding")),
        check_vectors(vectors, 256)[0],
        vectors.where("embedding is not null"),
    ):
        assert plan(df).count("ArrowEvalPython") == 1


def test_chunks_are_computed_once(spark):
    from passagemill.operators.chunk import chunk_sentences

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    assert plan(chunk_sentences(docs).where("content <> ''")).count("posexplode") == 1
    assert "Filter (size" not in plan(chunk_sentences(docs))
