import math
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from passagemill.operators.embed import check_vectors, embed, hash_embed, same_embedder
from checks.text_models import HashingEmbedder
from passagemill.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class SizeReporter:
    """Returns the request size and the text's number as its vector."""

    def make(self):
        return lambda texts: [[float(len(texts)), float(t)] for t in texts]


class Failing:
    def make(self):
        def predict(texts):
            if "bad" in texts:
                raise RuntimeError("no service")
            return [[1.0, 2.0] for _ in texts]

        return predict


def numbers(spark, n):
    return spark.range(0, n, 1, 1).select(F.col("id"), F.col("id").cast("string").alias("content"))


def test_requests_are_bounded_and_in_order(spark):
    rows = stage(embed(numbers(spark, 1000), SizeReporter()), "v", arrow_rows=10_000).collect()
    assert all(row["embedding"][1] == row["id"] for row in rows)
    sizes = [row["embedding"][0] for row in sorted(rows, key=lambda r: r["id"])]
    assert sizes == [150.0] * 900 + [100.0] * 100


def test_request_size_follows_a_small_arrow_batch(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = stage(embed(numbers(spark, 100), SizeReporter()), "v", arrow_rows=10).collect()
    assert {row["embedding"][0] for row in rows} == {10.0}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_failing_request(spark):
    texts = spark.createDataFrame([("good",), ("bad",), ("fine",)], "content string").coalesce(1)
    with pytest.raises(PythonException, match="no service"):
        embed(texts, Failing()).collect()
    rows = embed(texts, Failing(), batch=1, on_error="null").collect()
    found = {r["content"]: (r["embedding"], r["error"]) for r in rows}
    assert found["bad"] == (None, "no service")
    assert found["good"] == ([1.0, 2.0], None) == found["fine"]
    with pytest.raises(ValueError):
        embed(texts, Failing(), on_error="skip")


def test_hash_vectors(spark):
    rows = [(1, "One two two."), (2, ""), (3, None), (4, "TWO one; two")]
    df = spark.createDataFrame(rows, "id int, content string")
    found = {r["id"]: r["embedding"] for r in hash_embed(df, dim=32).collect()}
    assert found[3] is None and found[2] == [0.0] * 32
    assert found[1] == found[4]
    assert math.isclose(sum(x * x for x in found[1]), 1, rel_tol=1e-6)
    again = embed(df.where("content is not null"), HashingEmbedder(32)).collect()
    assert {r["id"]: r["embedding"] for r in again} == {i: found[i] for i in (1, 2, 4)}


def test_check_vectors(spark):
    rows = [
        (1, None),
        (2, []),
        (3, [0.0, 0.0]),
        (4, [1.0]),
        (5, [1.0, float("nan")]),
        (6, [1.0, float("inf")]),
        (7, [1.0, None]),
        (8, [3.0, 4.0]),
        (9, [3.0, 4.0]),
    ]
    good, bad = check_vectors(spark.createDataFrame(rows, "id int, embedding array<float>"), 2)
    assert {r["id"] for r in good.collect()} == {8, 9}
    assert {r["id"]: r["fault"] for r in bad.collect()} == {
        1: "null",
        2: "width",
        3: "zero",
        4: "width",
        5: "not finite",
        6: "not finite",
        7: "not finite",
    }


def test_embedders_must_match():
    same_embedder(("hashing", 64), ("hashing", 64))
    with pytest.raises(ValueError):
        same_embedder(("hashing", 64), ("hashing", 32))


def test_vectors_are_counted_in_runs_of_bounded_size(monkeypatch):
    """A batch of long texts is not counted at once, and the vectors are those of single rows."""
    import numpy as np
    import pyarrow as pa

    from passagemill.operators import embed as module

    true, sizes = np.bincount, []

    def counted(cells, minlength):
        sizes.append((len(cells), minlength))
        return true(cells, minlength=minlength)

    lists = [[f"w{i * j % 37}" for j in range(i % 9 * 100)] for i in range(60)] + [None, []]
    vectors = module._term_lists_to_unit_vectors(16)
    single = [vectors(pa.array([one], pa.list_(pa.string())))[0] for one in lists]
    monkeypatch.setattr(module, "RUN_TERMS", 1_000)
    monkeypatch.setattr(module, "RUN_CELLS", 16 * 10)
    monkeypatch.setattr(module.np, "bincount", counted)
    found = vectors(pa.array(lists, pa.list_(pa.string())))
    assert found.to_pylist() == [one.as_py() for one in single]
    assert max(terms for terms, _ in sizes) <= 1_000 and max(cells for _, cells in sizes) <= 160
