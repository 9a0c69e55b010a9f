import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import vector_cases
from pyspark.sql import functions as F

from passagemill.llm import inner_products
from passagemill.llm.inner_products import largest_products


def brute_force(given, k, scale=256):
    rows = [(key, [math.floor(scale * v) for v in vector]) for key, vector in vector_cases.whole(given)]
    out = Counter()
    for number, (key, asked) in enumerate(rows):
        if key is None or key % 50:
            continue
        found = []
        for other, (key_2, held) in enumerate(rows):
            if other != number:
                found.append((-sum(a * b for a, b in zip(asked, held)), math.inf if key_2 is None else key_2))
        for rank, (score, key_2) in enumerate(sorted(found)[:k], 1):
            out[key, rank, None if key_2 == math.inf else key_2, -score] += 1
    return out


def searched(table, k, **sizes):
    return Counter(map(tuple, largest_products(table, F.col("vec_id") % 50 == 0, k, **sizes).collect()))


@pytest.mark.parametrize("sizes", [{}, {"group_entries": 240, "block_entries": 30}])
def test_equals_brute_force(spark, sizes):
    given = vector_cases.rows()
    assert searched(vector_cases.table(spark, given), 5, **sizes) == brute_force(given, 5)


def test_fewer_rows_than_asked_for(spark, no_docs):
    given = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [0.0, 0.0])]
    assert searched(vector_cases.table(spark, given), 5) == brute_force(given, 5)
    assert searched(vector_cases.table(spark, given[:1]), 5) == Counter()
    assert searched(vector_cases.table(spark, given).where("false"), 5) == Counter()
    assert searched(vector_cases.table(spark, [(0, None), (50, [])]), 5) == Counter()


def test_entries_of_any_size(spark):
    given = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [1e9, 1e-30])]
    found = searched(vector_cases.table(spark, given), 2)
    assert sorted((row[1], row[2]) for row in found) == [(1, 2), (2, 1)]


def test_bounds_prune(spark, monkeypatch):
    """Skewed directions and lengths: most pairs are never multiplied, and the result stays exact."""
    draw = np.random.default_rng(3)
    held = np.floor(256 * draw.normal(size=(4_000, 32)) * (0.7 ** np.arange(32)))
    held *= draw.choice([1, 1, 1, 8], size=4_000)[:, None]
    values, axes = np.linalg.eigh(held.T @ held)
    rotation = inner_products.Rotation(axes[:, ::-1], (2, 6, 12))
    looked = []
    true_einsum = np.einsum
    monkeypatch.setattr(
        inner_products.np, "einsum", lambda how, a, b: looked.append(len(a)) or true_einsum(how, a, b)
    )
    numbers = np.arange(4_000)
    floor = np.sort(held[:40] @ held.T, axis=1)[:, -6].astype(float)
    best = inner_products._search(held[:40], floor, numbers[:40], held, numbers, numbers, rotation, 5)
    best.sort()
    q, score, row = best.parts[0]
    products = held[:40] @ held.T
    products[np.arange(40), np.arange(40)] = -np.inf
    want = -np.sort(-products, axis=1)[:, :5]
    assert np.array_equal(score.reshape(40, 5), want)
    assert sum(looked) < 0.1 * 40 * 4_000 and looked[-1] < 2_000


def test_questions_meet_only_groups_in_reach():
    longest, floors = np.array([9.0, 5.0, 5.0, 2.0]), np.array([-1.0, 0.0, 4.0, 10.0, 11.0, 18.0, 19.0])
    found = inner_products.groups_in_reach(np.full(7, 2.0), floors, longest)
    assert found.tolist() == [4, 4, 4, 3, 1, 1, 0]
    assert inner_products.groups_in_reach(np.zeros(2), np.array([-5.0, 1.0]), longest).tolist() == [4, 0]
