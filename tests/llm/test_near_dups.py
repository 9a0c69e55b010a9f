import random
import re

import numpy as np
import pyarrow as pa
import pytest

from passagemill.llm import near_dups
from passagemill.llm.near_dups import connect, drop_near_duplicates, near_duplicates
from passagemill.llm.word_hashes import word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width):
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[at : at + width]) for at in range(len(words) - width + 1)}


def brute_force(rows, width):
    sets = {key: shingles(text, width) for key, text in rows}
    above = {key: key for key in sets}

    def root(key):
        while above[key] != key:
            key = above[key]
        return key

    keys = sorted(sets)
    for at, a in enumerate(keys):
        for b in keys[at + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                above[high] = low
    return {key: (len(sets[key]), root(key), root(key) == key) for key in keys}


def edited(words, share, draw):
    return [draw.choice(words) + "x" if draw.random() < share else word for word in words]


@pytest.fixture(scope="module")
def groups():
    """Chains and stars of edited copies, exact copies, and texts that share a long passage."""
    draw = random.Random(5)
    vocabulary = [f"w{at}" for at in range(3000)]
    rows, key = [], 0
    passage = draw.choices(vocabulary, k=80)
    for _ in range(12):
        words = draw.choices(vocabulary, k=draw.choice([6, 30, 120, 300]))
        for step in range(draw.choice([1, 2, 6])):
            rows.append((key, " ".join(words)))
            key += 1
            words = edited(words, draw.choice([0, 0.01, 0.03]), draw)
    for _ in range(10):
        rows.append((key, " ".join(passage + draw.choices(vocabulary, k=40))))
        key += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(spark, groups, width):
    docs = spark.createDataFrame(groups, "doc_id long, text string").repartition(3)
    want = brute_force(groups, width)
    found = {
        row["doc_id"]: (row["n_shingles"], row["component_id"], row["kept"])
        for row in near_duplicates(docs, words=width).collect()
    }
    assert found == want
    assert len({component for _, component, _ in want.values()}) < len(want)


def test_edges(edge_docs, no_docs):
    found = near_duplicates(edge_docs, words=4).collect()
    assert len(found) == edge_docs.count()
    by_id = {row["doc_id"]: row for row in found if row["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[9]["component_id"] == 8
    for key in (3, 4, 5):
        assert by_id[key]["n_shingles"] == 0 and by_id[key]["component_id"] == key and by_id[key]["kept"]
    nameless = [row for row in found if row["doc_id"] is None]
    assert sorted(str(row["component_id"]) for row in nameless) == ["1", "None", "None"]
    assert near_duplicates(no_docs).count() == 0


def test_one_document_of_each_group_stays(edge_docs, no_docs):
    kept = drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [row["doc_id"] for row in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 9 not in ids and {3, 4, 5, 6, 7, 8} <= set(ids)
    assert drop_near_duplicates(no_docs).count() == 0


def test_unlike_texts_stay_under_one_id_and_without_id(spark):
    draw = random.Random(9)
    texts = [" ".join(draw.choices([f"w{at}" for at in range(500)], k=60)) for _ in range(5)]
    near = texts[4] + " end"
    rows = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[0]),
            (9, texts[1] + " end"), (None, texts[4]), (None, near), (7, texts[0]), (None, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {}
    for row, flag in zip(rows, [1, 1, 1, 1, 0, 0, None, None, 1, 1, 1]):
        found.setdefault((row[0], row[1]), flag)
    kept = [tuple(row) for row in drop_near_duplicates(docs).collect()]
    for row, flag in found.items():
        if flag is not None:
            assert kept.count(row) == flag, row
    assert kept.count((None, texts[4])) + kept.count((None, near)) == 1
    marks = near_duplicates(docs).collect()
    assert len(marks) == len(rows)
    assert sorted((row["component_id"], row["kept"]) for row in marks if row["component_id"] is not None) == [
        (7, False), (7, False), (7, True), (7, True), (7, True)
    ]
    assert sorted(row["kept"] for row in marks if row["component_id"] is None) == [False, *[True] * 5]


def test_connect_follows_long_chains(spark):
    chain = [(at, at + 1) for at in range(0, 40)] + [(100, 101), (101, 100), (102, 101)]
    links = spark.createDataFrame(chain, "a long, b long")
    labels = spark.createDataFrame([], "node long, label long")
    found = {row["node"]: row["label"] for row in connect(labels, links).collect()}
    assert all(found[at] == 0 for at in range(1, 41))
    assert found[101] == found[102] == 100


def test_odd_sketches_estimate_high_similarity():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 62, 2000).astype(np.uint64)
    other = base.copy()
    other[:200] = draw.integers(0, 1 << 62, 200).astype(np.uint64)
    true = 1800 / 2200
    sets = np.concatenate([np.sort(base), np.sort(other)])
    minima = near_dups.min_hashes(sets, np.array([0, 2000, 4000]))
    left, right = near_dups.odd_sketches(minima).view(np.uint64)
    differing = int(np.bitwise_count(left ^ right).sum())
    estimate = 1 + near_dups.SKETCH_BITS / 2 * np.log(1 - 2 * differing / near_dups.SKETCH_BITS) / (2 * near_dups.SAMPLES)
    assert abs(estimate - true) < 0.1
    assert near_dups.differing_bits(0.9) < near_dups.differing_bits(0.8)


def test_word_hashes_split_as_the_pattern(edge_rows):
    texts = [text for _, text in edge_rows]
    found = word_hashes(pa.array(["pad", *texts], pa.string()).slice(1))
    known = {}
    for at, text in enumerate(texts):
        hashes = found.hashes[found.first[at] : found.first[at + 1]].tolist()
        words = words_of(text)
        assert len(hashes) == len(words)
        for word, value in zip(words, hashes):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_workers_take_few_texts_at_once(spark, monkeypatch):
    from passagemill import session

    asked = []
    true = session.arrow_batch_rows
    monkeypatch.setattr(session, "arrow_batch_rows", lambda s, rows: asked.append(rows) or true(s, rows))
    text = "a stone house by the river and a light in its garden"
    docs = spark.range(0, 30, 1, 1).selectExpr("id as doc_id", f"'{text}' || repeat(' again', int(id)) as text")
    assert near_dups.near_duplicates(docs, words=4, similarity=80).count() == 30
    assert asked and set(asked) == {near_dups.BATCH_ROWS}
