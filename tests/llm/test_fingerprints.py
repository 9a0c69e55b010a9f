import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from passagemill.llm.fingerprints import (
    compare_versions,
    difference,
    edited_versions,
    next_ids,
    paragraph_keys,
    sketch,
    written,
)
from passagemill.llm.fingerprints import paragraphs as paragraphs_column


def chosen(last, before):
    """The cut rule by hand: Spark hashes several columns by handing on the seed."""
    seed = xxhash.xxh64_intdigest(last.encode(), 42)
    return last == before or xxhash.xxh64_intdigest(before.encode(), seed) % 8 == 0


def paragraphs(text):
    found = []
    for line in (text or "").split("\n"):
        for sentence in re.split(r"(?<=[.!?]) |(?<=[。！？])", line):
            words, begin = sentence.split(" "), 0
            for at in range(24, len(words)):
                if chosen(words[at - 1], words[at - 2]):
                    found.append(" ".join(words[begin:at]))
                    begin = at
            found.append(" ".join(words[begin:]))
    return Counter(one for one in found if one)


def likeness(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def test_versions_equal_brute_force(spark, edge_docs, edge_rows):
    draw = random.Random(5)
    plain = [f"w{draw.randrange(400)}" for _ in range(1500)]
    stops = [word + draw.choice(["", "", "", ".", "!\n", "。"]) for word in plain]
    more = [(90_001, " ".join(plain)), (90_002, " ".join(stops)), (90_003, " ".join(stops[400:] + plain[:300]))]
    schema = "doc_id long, text string"
    small = edge_docs.where("doc_id is not null").select("doc_id", "text").union(spark.createDataFrame(more, schema))
    rows = [(k, t or "") for k, t in edge_rows if k is not None] + more
    assert max(len(text) for _, text in rows) >= 100_000
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    found = compare_versions(edited_versions(small)).collect()
    assert len(found) == len(rows)
    for row in found:
        text = texts[row["doc_id"]]
        after = texts[order[(order.index(row["doc_id"]) + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(likeness(paragraphs(text), paragraphs(edited)))
        assert row["near_next"] == pytest.approx(likeness(paragraphs(text), paragraphs(after)))
    by_text = {}
    for row in found:
        assert by_text.setdefault(texts[row["doc_id"]], row["fingerprint"]) == row["fingerprint"]


def test_cuts_depend_on_nearby_words_alone(spark):
    sentence = "One of the stones was moved before winter came."
    plain = " ".join(f"w{at * at % 101}" for at in range(600))
    texts = {
        "short": " ".join([sentence] * 8),
        "long": " ".join([sentence] * 8) + " " + "And" * 10,
        "plain": plain,
        "edited": plain[:1500] + " nothing like it " + plain[700:900],
        "moved": " ".join(plain.split()[300:]),
        "again": "word " * 500,
        "signs": "早い。遅い。早い",
    }
    assert len(texts["short"]) < 400 < len(texts["long"])
    rows = spark.createDataFrame(list(texts.items()), "name string, text string")
    found = {r["name"]: r["cut"] for r in rows.select("name", paragraphs_column(F.col("text")).alias("cut")).collect()}
    for name in ("short", "plain", "again"):
        assert " ".join(found[name]).split() == texts[name].split()
    assert found["short"] == [sentence] * 8 and found["long"][:8] == [sentence] * 8
    assert len(found["plain"]) > 10 and len(found["again"]) > 100
    same = [one for one, other in zip(found["plain"], found["edited"]) if one == other]
    assert len(same) > 5 and len(" ".join(same)) > 1000
    assert found["moved"][2:] and found["moved"][-1] == found["plain"][-1]
    assert found["signs"] == ["早い。", "遅い。", "早い"]


def test_rows_without_id_have_no_next_document(spark):
    rows = spark.createDataFrame([(None, "abcdef"), (None, None)], "doc_id long, text string")
    found = {row["text"]: row["edited"] for row in edited_versions(rows).collect()}
    assert found == {"abcdef": "abcd", "": ""}
    assert compare_versions(edited_versions(rows.where("false"))).count() == 0


def test_next_ids_over_many_ranges(spark):
    rows = spark.range(0, 1_000, 3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = {row["doc_id"]: row["next_id"] for row in next_ids(rows.union(rows)).collect()}
    assert found == {at: at - 3 if at else 999 for at in range(0, 1_000, 3)}


def test_difference_recovers_all_digests_and_grows(spark):
    lists = [([1, 2, 3], [1, 2, 4]), ([], []), (list(range(500)), list(range(250, 900))), ([7], []), ([5], [5])]
    rows = [(at, a, b) for at, (a, b) in enumerate(lists)]
    found = difference(spark.createDataFrame(rows, "pair long, a array<long>, b array<long>")).collect()
    for at, a, b in rows:
        own = [row for row in found if row["pair"] == at]
        assert sorted(row["found"] for row in own if row["n"] == 1) == sorted(set(a) - set(b))
        assert sorted(row["found"] for row in own if row["n"] == -1) == sorted(set(b) - set(a))
        assert len(own) == len(set(a) ^ set(b))
        assert all((row["third"] > 8) == (len(a) == 500) for row in own)


def test_repeated_paragraphs_count(spark):
    rows = spark.createDataFrame([(0, "a\na\nb"), (1, "a\nb"), (2, "b\na\na"), (3, "")], "id long, text string")
    keyed = rows.select("id", paragraph_keys(F.col("text")).alias("keys"))
    assert [len(row["keys"]) for row in keyed.orderBy("id").collect()] == [3, 2, 3, 0]
    printed = keyed.select("id", written(sketch(F.col("keys"), F.lit(8).cast("long"))).alias("fingerprint"))
    found = {row["id"]: row["fingerprint"] for row in printed.collect()}
    assert found[0] == found[2] != found[1] and found[3] == ""


def test_plan_is_native(edge_docs):
    plan = compare_versions(edited_versions(edge_docs))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_difference_at_once_is_that_of_the_sketches(spark):
    from passagemill.llm.fingerprints import _difference, subtract

    draw = random.Random(9)
    rows = [([draw.randrange(60) for _ in range(size)], [draw.randrange(60) for _ in range(40)]) for size in (0, 1, 90)]
    pairs = spark.createDataFrame([(sorted(set(a)), sorted(set(b))) for a, b in rows], "a array<long>, b array<long>")
    for size in (F.lit(1).cast("long"), F.lit(8).cast("long"), F.lit(200).cast("long")):
        apart = subtract(sketch(F.col("a"), size), sketch(F.col("b"), size))
        found = pairs.select(apart.alias("x"), _difference(F.col("a"), F.col("b"), size).alias("y")).collect()
        assert all(row["x"] == row["y"] for row in found)


def test_wide_sketches_give_up_nearly_all_in_one_round(spark):
    from passagemill.llm import fingerprints

    draw = random.Random(4)
    keys = [[draw.getrandbits(62) for _ in range(size)] for size in (40, 200, 1)]
    rows = [(a + keys[1][:shared], b + keys[1][:shared]) for a in keys for b in ([], keys[0][:7]) for shared in (0, 30)]
    pairs = spark.createDataFrame(rows, "a array<long>, b array<long>")
    pairs = pairs.select(F.array_distinct("a").alias("a"), F.array_distinct("b").alias("b"))
    width = F.ceil((F.size("a") + F.size("b")) * F.lit(fingerprints.SECOND)).cast("long")
    cells = fingerprints._difference(F.col("a"), F.col("b"), width)
    pure = F.filter(cells, lambda one: (F.abs(one["n"]) == 1) & (one["check"] == fingerprints._check(one["key"])))
    peeled = fingerprints.peel(cells, width)
    found = pairs.select("a", "b", F.transform(pure, lambda one: one["key"]).alias("pure"), peeled.alias("peeled"))
    for row in found.collect():
        differ = set(row["a"]) ^ set(row["b"])
        signs = [(key, 1 if key in set(row["a"]) else -1) for key in differ]
        assert sorted(map(tuple, row["peeled"]["recovered"])) == sorted(signs) and not row["peeled"]["cells"]
        assert len(set(row["pure"])) >= 0.97 * len(differ)


def test_keys_of_repeated_and_single_paragraphs_are_alike(spark):
    texts = ["a. b! c? d", "d\nc?\nb!\na.", "a. a. b", "b\na.\na.", "早い。遅い。. x", ". . a", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = rows.select("text", paragraphs_column(F.col("text")).alias("cut"), paragraph_keys(F.col("text")).alias("keys"))
    held = {row["text"]: (row["cut"], row["keys"]) for row in found.collect()}
    for text, (cut, keys) in held.items():
        assert Counter(cut) == paragraphs(text)
        assert len(set(keys)) == len(keys) == len(cut)
    assert set(held[texts[0]][1]) == set(held[texts[1]][1])
    assert len(set(held[texts[2]][1]) & set(held[texts[3]][1])) == 3
