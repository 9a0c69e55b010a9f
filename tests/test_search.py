import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.operators.index import (
    build_index,
    probes_for_recall,
    recall_by_probes,
    vector_topk_bounded,
    vector_topk_indexed,
)
from passagemill.operators.keyword_search import (
    corpus_totals,
    document_frequency,
    keyword_lookup,
    keyword_topk,
)
from passagemill.operators.rerank import rerank_with
from passagemill.operators import topk
from passagemill.operators.topk import met
from passagemill.operators.vector_search import METRICS, question_faults, vector_topk
from checks.text_models import WordShareScorer

DIM = 6
VECTORS = "id string, embedding array<float>"


def score(metric, q, v):
    q, v = np.float32(q).astype(float), np.float32(v).astype(float)
    if metric == "l2":
        return -math.sqrt(((q - v) ** 2).sum())
    if metric == "dot":
        return float(q @ v)
    return float(q @ v / math.sqrt((q @ q) * (v @ v)))


def brute(metric, queries, base, k):
    found = set()
    for qid, q in queries:
        hits = sorted((-(round(score(metric, q, v), 6) + 0.0), i) for i, v in base)
        found |= {(qid, rank, i, -s) for rank, (s, i) in enumerate(hits[:k], 1)}
    return found


@pytest.fixture(scope="module")
def data():
    """A third of the base are copies of one vector."""
    rng = np.random.default_rng(7)
    base = [(f"v{i:03d}", rng.normal(size=DIM).tolist()) for i in range(200)]
    base += [(f"c{i:03d}", base[0][1]) for i in range(100)]
    queries = [(i, rng.normal(size=DIM).tolist()) for i in range(25)] + [(99, base[0][1])]
    return queries, base


def frames(spark, data):
    queries, base = data
    return (
        spark.createDataFrame(queries, "query_id int, embedding array<float>"),
        spark.createDataFrame(base, VECTORS).repartition(4),
    )


def rows(df):
    return {tuple(row) for row in df.select("query_id", "rank", "id", "score").collect()}


@pytest.fixture
def no_broadcast(monkeypatch):
    """Questions are taken as too large to be broadcast."""
    monkeypatch.setattr(topk, "BROADCAST_BYTES", -1)


@pytest.mark.parametrize("metric", METRICS)
def test_exact_search_in_place(spark, data, metric, monkeypatch):
    queries, base = frames(spark, data)
    found = vector_topk(queries, base, DIM, 4, metric)
    assert rows(found) == brute(metric, *data, 4)
    # best rows are cut and merged many times in each task
    monkeypatch.setattr(topk.TaskBest, "__init__", frequent_cuts(topk.TaskBest.__init__))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(vector_topk(queries, base, DIM, 4, metric)) == brute(metric, *data, 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def frequent_cuts(init):
    def changed(self, questions, k):
        init(self, questions, k)
        self.cut_at = 1

    return changed


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("block_rows", [4096, 7])
def test_exact_search(spark, data, metric, block_rows, monkeypatch, no_broadcast):
    monkeypatch.setattr(met, "__defaults__", (90,))  # several groups of base rows
    queries, base = frames(spark, data)
    found = rows(vector_topk(queries, base, DIM, 4, metric, block_rows=block_rows))
    assert found == brute(metric, *data, 4)


def test_odd_questions_do_not_touch_the_others(spark, data):
    queries, base = data
    odd = [(200, [1.0, 2.0, 3.0]), (201, [0.5] * 9), (202, None)]
    asked, held = frames(spark, (queries + odd, base))
    assert rows(vector_topk(asked, held, DIM, 4)) == brute("cosine", queries, base, 4)
    faults = {r["query_id"]: r["fault"] for r in question_faults(asked, DIM).collect()}
    assert faults == {200: "width", 201: "width", 202: "null"}


def test_large_searches_never_collect_a_side(spark, data, monkeypatch, no_broadcast):
    queries, base = frames(spark, data)

    def refused(*_):
        raise AssertionError("rows went through the driver")

    for name in ("toArrow", "toPandas", "collect", "toLocalIterator"):
        monkeypatch.setattr(type(queries), name, refused)
    vector_topk(queries, base, DIM, 4).write.format("noop").mode("overwrite").save()


def test_only_questions_of_a_checked_size_are_collected(spark, data, monkeypatch):
    queries, base = frames(spark, data)
    collected = []
    true = type(queries).toArrow
    monkeypatch.setattr(type(queries), "toArrow", lambda df: collected.append(true(df)) or true(df))
    assert vector_topk(queries, base, DIM, 4).count() == 26 * 4
    assert [table.num_rows for table in collected] == [26]
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 26 * (8 * DIM + 64) - 1)
    assert vector_topk(queries, base, DIM, 4).count() == 26 * 4 and len(collected) == 1


def test_k_beyond_the_base(spark, data):
    queries, base = data
    small = base[:3]
    found = rows(vector_topk(*frames(spark, (queries, small)), DIM, 10))
    assert found == brute("cosine", queries, small, 10)


def test_empty_sides(spark, data):
    queries, base = frames(spark, data)
    assert vector_topk(queries.limit(0), base, DIM, 3).count() == 0
    assert vector_topk(queries, base.limit(0), DIM, 3).count() == 0
    assert vector_topk(queries.limit(0), base, DIM, 3).columns == ["query_id", "rank", "id", "score"]


def test_unusable_vectors_are_no_hits(spark):
    base = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("z", [0.0, 0.0]), ("w", [1.0]), ("n", None), ("x", [1.0, None])],
        VECTORS,
    )
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    found = rows(vector_topk(queries, base, 2, 9))
    assert found == {(1, 1, "a", 1.0), (1, 2, "z", 0.0)}


def test_duplicate_question_keys_are_refused(spark):
    same = spark.range(50).select(F.lit(1).alias("query_id"), F.array(F.lit(1.0)).alias("embedding"))
    base = spark.createDataFrame([("a", [1.0])], VECTORS)
    for size in (2, 50):
        with pytest.raises(ValueError, match="not unique"):
            vector_topk(same.limit(size), base, 1)


def test_unknown_metric(spark, data):
    with pytest.raises(ValueError):
        vector_topk(*frames(spark, data), DIM, 1, "manhattan")


def test_index_search(spark, data, folder):
    queries, base = frames(spark, data)
    index = build_index(base, folder + "/index", dim=DIM, cells=5, embedder="test")
    model = ("test", DIM)
    assert rows(vector_topk_indexed(queries, index, model, 4, 5)) == brute("cosine", *data, 4)
    few = rows(vector_topk_indexed(queries, index, model, 4, 1, "l2"))
    exact = brute("l2", *data, 4)
    cell = {r["id"]: r["cell"] for r in index.rows(spark).select("id", "cell").collect()}
    assert len(cell) == 300 and set(cell.values()) <= set(range(5))
    vectors = dict(data[1])
    for qid, q in data[0]:
        nearest = min(
            range(len(index.centroids)),
            key=lambda c: ((np.float32(q) - index.centroids[c]) ** 2).sum(),
        )
        inside = [(i, vectors[i]) for i in vectors if cell[i] == nearest]
        assert {h for h in few if h[0] == qid} == brute("l2", [(qid, q)], inside, 4)
    curve = {r["probes"]: r for r in recall_by_probes(queries, index, 4, "l2").collect()}
    assert curve[5]["recall"] == 1.0 and curve[5]["found_hits"] == len(exact)
    hit = {(q, i) for q, _, i, _ in exact}
    for probes in range(1, 6):
        near = {(q, i) for q, _, i, _ in rows(vector_topk_indexed(queries, index, model, 4, probes, "l2"))}
        assert curve[probes]["found_hits"] == len(hit & near)
    enough = probes_for_recall(queries, index, 4, 0.8, "l2")
    assert curve[enough]["recall"] >= 0.8 and all(curve[p]["recall"] < 0.8 for p in range(1, enough))
    for other in (("other", DIM), ("test", DIM + 1)):
        with pytest.raises(ValueError):
            vector_topk_indexed(queries, index, other, 4, 1)


@pytest.mark.parametrize("metric, broadcast", [("cosine", True), ("l2", True), ("dot", False)])
def test_bounded_search_is_exact_with_fewer_cells(spark, folder, metric, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(topk, "BROADCAST_BYTES", -1)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, DIM)) * 6
    base = [(f"v{i:03d}", (centres[i % 12] + rng.normal(size=DIM) * 0.3).tolist()) for i in range(240)]
    base += [("far", (centres[3] * 4).tolist())]
    queries = [(i, (centres[i] + rng.normal(size=DIM) * 0.3).tolist()) for i in range(12)] + [(90, [0.0] * DIM)]
    asked, held = frames(spark, (queries, base))
    index = build_index(held, folder, dim=DIM, cells=12, embedder="test", centroids=centres)
    some = vector_topk_bounded(asked, index, ("test", DIM), 4, 1, metric)
    real = queries if metric != "cosine" else queries[:-1]
    want = brute(metric, real, base, 4)
    found = {row for row in rows(some) if metric != "cosine" or row[0] != 90}
    assert found == want
    assert some.agg(F.min("probed_cells")).first()[0] < 12
    many = vector_topk_bounded(asked, index, ("test", DIM), 300, 1, metric)
    assert many.groupBy("query_id").count().where("count <> 241").count() == 0


def test_search_memory_and_exactness_beyond_one_matrix(monkeypatch):
    """Ties, near ties and long vectors, over several blocks of questions and rows; no array of
    pairs is larger than asked for."""
    from passagemill.operators import vector_search as vs

    rng = np.random.default_rng(5)
    rows_ = np.concatenate([rng.random((300, 16)), np.tile(rng.random((1, 16)), (200, 1))])
    rows_[7, 3] = np.nan
    asked = np.concatenate([rng.random((40, 16)), rows_[-1:], rows_[:1] + 1e-7])
    rows_, asked = rows_.astype(np.float32), asked.astype(np.float32)
    monkeypatch.setattr(vs, "SCORE_CELLS", 640)
    monkeypatch.setattr(vs, "QUESTION_STEP", 16)
    monkeypatch.setattr(vs, "PAIR_CELLS", 160)
    true, most = vs._pair_scores, []
    monkeypatch.setattr(vs, "_pair_scores", lambda q, r, m: most.append(q.size) or true(q, r, m))
    for scale in (1.0, 1e18):
        for metric in METRICS:
            found = vs._best(vs._Side(asked * np.float32(scale), metric, True), rows_ * np.float32(scale), metric, 3)
            found.sort()
            question, score, row = found.parts[0]
            for q in range(len(asked)):
                pairs = np.tile(asked[q] * np.float32(scale), (len(rows_), 1))
                scores = np.where(np.isnan(rows_).any(axis=1), -np.inf, true(pairs, rows_ * np.float32(scale), metric))
                order = np.lexsort((np.arange(len(rows_)), -scores))[:3]
                assert row[question == q].tolist() == order.tolist()
                assert score[question == q].tolist() == scores[order].tolist()
    assert max(most) <= 160


# ---- keywords

WORDS = ["red", "green", "blue", "Straße", "sun", "moon", "the"]


def texts():
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(WORDS, rng.integers(0, 12)))) for i in range(60)]
    docs += [(i, "the the sun, THE moon") for i in range(60, 90)] + [(90, None)]
    queries = [(i, " ".join(rng.choice(WORDS, 3))) for i in range(20)]
    return queries + [(50, "unknown"), (51, ""), (52, "the the the")], docs


def bm25(queries, docs, k):
    words = {i: t.lower().replace(",", "").split() for i, t in docs if t is not None}
    mean = sum(map(len, words.values())) / len(words)
    found = set()
    for qid, query in queries:
        hits = []
        for i, body in words.items():
            total = 0.0
            for word in set(query.lower().split()):
                df = sum(word in other for other in words.values())
                tf = body.count(word)
                rarity = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                total += rarity * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(body) / mean))
            if total > 0:
                hits.append((-round(total, 6), i))
        found |= {(qid, rank, i, -s) for rank, (s, i) in enumerate(sorted(hits)[:k], 1)}
    return found


@pytest.mark.parametrize("block, most", [(256, 4096), (4, 4096), (256, 0), (4, 0)])
def test_keyword_search(spark, block, most, monkeypatch):
    """Questions broadcast, and dealt into blocks as if they were too many for that."""
    monkeypatch.setattr("passagemill.operators.keyword_search.SCANNED_QUESTIONS", most)
    queries, docs = texts()
    asked = spark.createDataFrame(queries, "query_id int, query string")
    corpus = spark.createDataFrame(docs, "id int, content string").repartition(3)
    expected = bm25(queries, docs, 3)
    assert rows(keyword_topk(asked, corpus, 3, block_questions=block)) == expected
    stored = dict(term_counts=document_frequency(corpus), totals=corpus_totals(corpus))
    assert rows(keyword_topk(asked, corpus, 3, block_questions=block, **stored)) == expected
    with pytest.raises(ValueError):
        keyword_topk(asked, corpus, 3, totals=stored["totals"])


def test_hits_whose_score_rounds_to_zero_are_kept(spark):
    corpus = spark.createDataFrame([(i, "the") for i in range(5)], "id int, content string")
    asked = spark.createDataFrame([(1, "the")], "query_id int, query string")
    # a term that all of three million rows hold is worth less than the last digit of a score
    stored = dict(
        term_counts=spark.createDataFrame([("the", 3_000_000)], "term string, doc_count long"),
        totals=spark.createDataFrame([(3_000_000, 3_000_000)], "rows long, terms long"),
    )
    found = rows(keyword_topk(asked, corpus, 2, **stored))
    assert found == {(1, 1, 0, 0.0), (1, 2, 1, 0.0)}


def test_keyword_lookup_cuts_text(spark):
    corpus = spark.createDataFrame([(1, "sun " * 100), (2, "moon")], "id int, content string")
    asked = spark.createDataFrame([(7, "sun")], "query_id int, query string")
    found = keyword_lookup(asked, corpus).collect()
    assert [(r["query_id"], r["id"], len(r["snippet"])) for r in found] == [(7, 1, 100)]


def test_rerank_is_a_subset_of_its_input(spark):
    rows_ = [(1, i, "sun moon", "sun" if i % 2 else "sun and moon") for i in range(5)]
    candidates = spark.createDataFrame(
        rows_, "query_id int, id int, query string, content string"
    )
    found = rerank_with(candidates, WordShareScorer(), 3).orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["score"]) for r in found] == [(1, 0, 1.0), (2, 2, 1.0), (3, 4, 1.0)]
    assert Counter(r["query_id"] for r in found) == {1: 3}


def test_second_lookup_computes_its_texts_once(spark):
    from passagemill.operators.keyword_search import two_hop_lookup

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(number):
        read.add(1)
        return f"sun {number}"

    docs = spark.range(6).select("id", text.asNondeterministic()("id").alias("content"))
    first = spark.createDataFrame([(1, 1, "sun, 4")], "query_id int, rank int, content string")
    found = two_hop_lookup(first, docs).collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in found] == [(1, 1, 4)]
    assert read.value == 6
