import math

import numpy as np
import pytest
import vector_cases

from passagemill.llm import whitening
from passagemill.llm.registry import QUERIES
from passagemill.llm.whitening import whiten


def integers(given, width):
    rows = []
    for key, vector in vector_cases.whole(given):
        entries = [math.floor(64 * v) + 1_000_000 for v in vector]
        rows.append((key, tuple(entries + [1_000_000] * (width - len(entries)))))
    return rows


def brute_force(rows, components, fit="count"):
    """Over the rows one by one, in longs and doubles."""
    fitted = [x for _, x in rows] if fit == "count" else sorted({x for _, x in rows})
    n = len(fitted)
    sums = [sum(x[at] for x in fitted) for at in range(len(fitted[0]))]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fitted])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for key, x in rows:
        gaps = [n * v - s for v, s in zip(x, sums)]
        whitened = (np.array(gaps, dtype=float) / n) @ axes[:, :components] / np.sqrt(values[:components])
        out.append((key, n, sum(gap * gap for gap in gaps), whitened))
    return out, values / np.trace(covariance)


def found_rows(df):
    """The rows of one key and vector together: components in order."""
    by_component = {}
    for row in df.collect():
        by_component.setdefault(row["component"], []).append(row)
    return by_component


@pytest.mark.parametrize("fit", ["count", "one"])
def test_equals_brute_force(spark, fit):
    given = vector_cases.rows()
    want, shares = brute_force(integers(given, 6), 4, fit)
    found = found_rows(whiten(vector_cases.table(spark, given), components=4, fit=fit))
    assert sorted(found) == [1, 2, 3, 4]
    name = lambda key: -1 if key is None else key
    for component, rows in found.items():
        assert len(rows) == len(want)
        got = np.array(sorted((name(r["id"]), int(r["deviation"]), r["whitened"]) for r in rows))
        one = sorted((name(key), total, w[component - 1]) for key, _, total, w in want)
        other = sorted((name(key), total, -w[component - 1]) for key, _, total, w in want)
        assert np.array_equal(got[:, 0], np.array(one)[:, 0])
        close = [np.abs(got[:, 2] - np.array(side)[:, 2]).max() < 1e-8 for side in (one, other)]
        assert any(close)
        assert {r["n"] for r in rows} == {want[0][1]}
        assert sorted((name(r["id"]), int(r["deviation"])) for r in rows) == sorted(
            (name(key), total) for key, _, total, _ in want
        )
        assert abs(rows[0]["explained"] - shares[component - 1]) < 1e-12
        assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_frequent_vectors_are_not_shuffled(spark, monkeypatch):
    """With a lower bound some vectors are broadcast and others joined: the same rows."""
    given = vector_cases.rows()
    table = vector_cases.table(spark, given).select("vec_id", "embedding").persist()
    rows = lambda: sorted(
        (str(r["id"]), r["component"], r["deviation"], round(r["whitened"], 9)) for r in whiten(table, components=2).collect()
    )
    usual = rows()
    monkeypatch.setattr(whitening, "FREQUENT", 4)
    assert rows() == usual
    monkeypatch.setattr(whitening, "FREQUENT", 10**9)
    assert rows() == usual


def test_no_spread(spark):
    given = [(key, [1.0, 2.0, 3.0]) for key in range(4)]
    rows = whiten(vector_cases.table(spark, given)).collect()
    assert len(rows) == 12
    assert all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in rows)
    assert {r["identity_error"] for r in rows} == {0.0}
    line = [(key, [float(key), 2.0 * key, 0.0]) for key in range(9)]
    rows = whiten(vector_cases.table(spark, line)).collect()
    assert {r["component"] for r in rows if r["whitened"] is not None} == {1}
    assert abs(rows[0]["identity_error"]) < 1e-9 and abs(max(r["explained"] for r in rows) - 1) < 1e-12


def test_edges(spark):
    given = [(1, None), (2, [None, 1.0]), (3, [float("nan")])]
    assert whiten(vector_cases.table(spark, given)).count() == 0
    assert whiten(vector_cases.table(spark, [(3, [])])).count() == 0
    large = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])]
    assert whiten(vector_cases.table(spark, large)).count() == 6
    with pytest.raises(ValueError):
        whiten(vector_cases.table(spark, given), fit="all")


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = QUERIES["op12_whitening"](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, _ = brute_force(integers([tuple(row) for row in table], 64), 32)
    assert len(rows) == 32 * len(want)
    exact = {key: total for key, _, total, _ in want}
    assert all(exact[row["vec_id"]] == row["deviation"] for row in rows)
    assert all(row["identity_error"] <= 1e-4 for row in rows)
