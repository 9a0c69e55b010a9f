import random
import re
import time
import zlib
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagemill.llm import periodic_runs
from passagemill.llm.periodic_runs import collapsed, find_runs, runs_of, split_by_frequency, word_codes
from passagemill.llm.registry import QUERIES


def brute_force(words):
    """All runs, by looking at every period and place."""
    runs, n = [], len(words)
    for period in range(1, n // 4 + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(6, 4 * period):
                part = words[start : start + length]
                if all(part[d:] != part[:-d] for d in range(1, period)):
                    runs.append((start, length, period))
            start = end + 1
    return sorted(runs, key=lambda run: (run[0], run[2]))


def brute_collapse(words, runs):
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in gone)


def changed(key, text):
    """The words of the query's text for a document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + at % period] for at in range(n - a)]


def want_row(key, text):
    words = changed(key, text)
    runs = brute_force(words)
    digest = sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None,) * 3)
    rest = sha256(brute_collapse(words, runs).encode()).hexdigest()
    ratio = None if length is None else 1000 * length // period
    return key, len(runs), start, length, period, ratio, digest, rest


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 7), st.integers(0, 40), st.integers(0, 30))
def test_equals_brute_force(numbers, period, times, at):
    part = (numbers[at : at + period] or [9]) * times
    words = [b"%d" % number for number in numbers[:at] + part + numbers[at:]]
    runs = runs_of(words)
    assert runs == brute_force(words)
    assert collapsed(words, runs).decode() == brute_collapse([word.decode() for word in words], runs)


def test_splitting_keeps_every_run_and_reaches_stability():
    draw = random.Random(2)
    for _ in range(200):
        words = [b"%d" % draw.choice([draw.randrange(4), draw.randrange(40)]) for _ in range(draw.randrange(200))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = words[:5] * 5
        places = split_by_frequency(word_codes(words))
        left = set(places.tolist())
        for start, length, _ in brute_force(words):
            assert set(range(start, start + length)) <= left
        if len(places):
            first, last = periodic_runs._stretches(places)
            for begin, end in zip(first, last):
                counts = np.unique([words[at] for at in range(begin, end + 1)], return_counts=True)[1]
                assert counts.min() >= 4 and end - begin >= 5


def test_rounds_change_no_result(monkeypatch):
    words = [b"%d" % (at & -at) for at in range(1, 600)] + [b"a", b"b"] * 9
    want = brute_force(words)
    for rounds in (1, 2, 64):
        monkeypatch.setattr(periodic_runs, "ROUNDS", rounds)
        assert runs_of(words) == want


def test_long_texts_stay_fast():
    draw = random.Random(3)
    block = [b"%d" % draw.randrange(300) for _ in range(20_000)]
    began = time.time()
    assert runs_of(block * 10) == [(0, 200_000, 20_000)]
    assert runs_of([b"a"] * 300_000) == [(0, 300_000, 1)]
    assert runs_of(([b"a"] * 5 + [b"b"]) * 40_000) == [(0, 240_000, 6)]
    assert time.time() - began < 30


def test_edges(spark, edge_docs, edge_rows, no_docs):
    found = find_runs(edge_docs).collect()
    assert len(found) == len(edge_rows)
    by_text = {row["row"]["text"]: row for row in found}
    for _, text in edge_rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        row = by_text[text]
        assert row["n_words"] == len(words)
        if len(words) < 2_000:
            assert [tuple(run) for run in row["runs"]] == brute_force(words)
        if not row["runs"]:
            assert row["collapsed"] == " ".join(words)
    assert set(found[0]["row"].asDict()) == set(edge_docs.columns)
    assert find_runs(no_docs).count() == 0
    twice = edge_docs.select("doc_id", F.lit("a b a b a b a b c").alias("text"), F.lit(1).alias("runs"))
    assert {(row["collapsed"], tuple(row["runs"][0])) for row in find_runs(twice).collect()} == {("a b c", (0, 8, 2))}


def test_query_equals_brute_force(spark, folder):
    draw = random.Random(8)
    texts = [" ".join(draw.choices("abcdefgh" if key % 2 else [str(at) for at in range(90)], k=draw.randrange(120))) for key in range(150)]
    texts += ["a b " * 20 + "c" + " x" * 9, None, "", " \n\t", "é é é é é é é é\x0bé"]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None), (3, texts[3]), (3, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, folder)
    key = lambda row: tuple((value is None, value) for value in row)
    assert sorted(map(tuple, found.collect()), key=key) == sorted((want_row(*row) for row in rows), key=key)
    assert sum(row[1] for row in map(tuple, found.collect())) > 10
