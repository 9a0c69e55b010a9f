import random
import zlib
from collections import Counter

import pytest

from passagemill.llm.toxicity import (
    Lexicon,
    drop_toxic,
    features_of,
    fit_toxicity,
    learn_lexicon,
    learned_rows,
    plain_word,
    score_toxicity,
    terms_of,
)


@pytest.fixture(scope="module")
def marked(spark):
    """Texts whose toxic ones hold two or three words that begin alike or are insults."""
    draw = random.Random(11)
    stock = [f"{a}{b}" for a in ("ri", "sto", "ho", "li", "ga", "fe") for b in ("ver", "ne", "use", "ght", "rden", "nce")]
    docs, labels = [], []
    for key in range(900):
        words = draw.choices(stock, k=draw.randint(30, 120))
        toxic = int(draw.random() < 0.2)
        for _ in range(draw.randint(2, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["scummy", "zorrak" + draw.choice(stock), "f00lish"]))
        docs.append((key, " ".join(words), "en"))
        labels.append((key, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4).cache(),
        spark.createDataFrame(labels, "doc_id long, toxic int").cache(),
    )


def held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def test_held_out_accuracy(marked):
    docs, labels = marked
    truth = {row["doc_id"]: row["toxic"] for row in labels.collect()}
    rows = score_toxicity(docs, fit_toxicity(docs, labels)).select("row.doc_id", "score", "predicted").collect()
    assert len(rows) == 900 and all(0 <= row["score"] <= 1 for row in rows)
    unseen = [row for row in rows if held_out(row["doc_id"])]
    right = sum(row["predicted"] == truth[row["doc_id"]] for row in unseen)
    assert right / len(unseen) > 0.95
    assert all(row["predicted"] == int(row["score"] >= 0.3) for row in rows)


def test_rare_terms_of_many_toxic_texts_are_learned(spark):
    """Every term that the odds let pass is kept, however many frequent ones there are."""
    draw = random.Random(5)
    rows = []
    for key in range(1_200):
        words = [f"word{draw.randrange(400)}" for _ in range(20)]
        toxic = key % 2
        words += [f"q{draw.randrange(100):02d}mark{draw.randrange(2)}"] if toxic else []
        rows.append((key, " ".join(words), toxic))
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    lexicon = learn_lexicon(sample)
    counts = {0: Counter(), 1: Counter()}
    for _, text, toxic in rows:
        counts[toxic].update({term for word in text.split() for term in terms_of(word)})
    everything = Lexicon(
        {term: (n, counts[0][term]) for term, n in counts[1].items()}, 600, 600
    )
    wanted = {
        term: both for term, both in everything.terms.items()
        if everything.weight(term) or everything.weight(term, 0)
    }
    assert lexicon.terms == wanted and len(wanted) > 100
    assert (lexicon.toxic, lexicon.clean) == (600, 600)


def test_held_out_rows_are_never_learned(marked):
    docs, labels = marked
    sample = learned_rows(docs, labels, 10_000)
    ids = {row["doc_id"] for row in sample.select("doc_id").collect()}
    assert ids == {key for key in range(900) if not held_out(key)}
    assert learned_rows(docs, labels, 300).count() < 450


def test_edges(marked, edge_docs, no_docs):
    docs, labels = marked
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(edge_docs, model)
    assert scored.count() == edge_docs.count() and scored.select("row.*").columns == edge_docs.columns
    by_text = {}
    for row in scored.select("row.text", "score").collect():
        assert by_text.setdefault(row["text"] or "", row["score"]) == row["score"]
    assert score_toxicity(no_docs, model).count() == 0
    nothing = labels.where("false")
    kept = drop_toxic(edge_docs, nothing)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    one_class = fit_toxicity(docs, labels.where("toxic = 0"))
    assert {row["score"] for row in score_toxicity(docs, one_class).collect()} == {0.0}
    assert fit_toxicity(no_docs, labels).trees is None


def test_words_are_read_through_their_disguise():
    assert plain_word("F00L!") == plain_word("fool")
    assert plain_word("s-c-u-m,") == "scum"
    assert plain_word("123") == "123" and plain_word("&&&") == ""


def test_features_of_nothing():
    assert set(features_of("", [], [])) == {0.0}


def test_texts_are_taken_in_parts_and_no_cache_is_left(spark, monkeypatch):
    import pyarrow as pa

    from passagemill.llm import toxicity
    from passagemill.llm.toxicity import Lexicon, with_features

    rows = spark.range(0, 25, 1, 2).selectExpr("id as doc_id", "'you are mean ' || id as text")
    lexicon = Lexicon({"=mean": (9, 0)}, 10, 10)
    whole = sorted(map(tuple, with_features(rows, lexicon).collect()))
    monkeypatch.setattr(toxicity, "PART_ROWS", 4)
    assert sorted(map(tuple, with_features(rows, lexicon).collect())) == whole and len(whole) == 25

    def held(batches):
        from passagemill.llm.common import worker_state

        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": len(worker_state("cache"))}])

    assert {row["n"] for row in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}
