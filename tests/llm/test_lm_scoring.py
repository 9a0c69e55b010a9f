import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from passagemill.llm.lm_scoring import _packed, _unpacked, fit_ngram_model, score_documents
from passagemill.llm.ngram_trie import (
    Trie,
    build_trie,
    discounts,
    encode_monotone,
    encode_scale,
    monotone_at,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


class BruteForce:
    def __init__(self, texts):
        lists = [tokens_of(text) for text in texts]
        self.texts = len(lists)
        self.words = Counter(token for tokens in lists for token in tokens)
        starts = [["begin of text", *tokens] for tokens in lists]
        self.pairs = Counter(pair for tokens in starts for pair in zip(tokens, tokens[1:]))
        self.triples = Counter(one for tokens in starts for one in zip(tokens, tokens[1:], tokens[2:]))
        self.total = sum(self.words.values())
        taken = [discounts(np.array(list(counts.values()) or [0])) for counts in (self.pairs, self.triples)]
        self.pair_taken, self.triple_taken = taken
        self.pair_mass, self.triple_mass = defaultdict(float), defaultdict(float)
        for (a, _), count in self.pairs.items():
            self.pair_mass[a] += self.pair_taken[min(count, 3)]
        for (a, b, _), count in self.triples.items():
            self.triple_mass[a, b] += self.triple_taken[min(count, 3)]

    def probability(self, tokens, at):
        single = (self.words[tokens[at]] + 0.5) / (self.total + 0.5 * (len(self.words) + 1))
        a = tokens[at - 1]
        held = self.texts if a == "begin of text" else self.words[a]
        p = single
        if a in self.pair_mass:
            count = self.pairs[a, tokens[at]]
            p = (count - self.pair_taken[min(count, 3)]) / held + self.pair_mass[a] / held * single
        if at > 1 and (tokens[at - 2], a) in self.triple_mass:
            b = tokens[at - 2]
            count, held = self.triples[b, a, tokens[at]], self.pairs[b, a]
            p = (count - self.triple_taken[min(count, 3)]) / held + self.triple_mass[b, a] / held * p
        return single, p

    def scores(self, text):
        tokens = ["begin of text", *tokens_of(text)]
        both = [self.probability(tokens, at) for at in range(1, len(tokens))]
        return tuple(sum(math.log10(one[place]) for one in both) for place in (0, 1))


@pytest.mark.parametrize("shard_tokens", [10**9, 40_000])
def test_scores_equal_brute_force(edge_docs, edge_rows, shard_tokens):
    train = edge_docs.where("doc_id % 2 = 1 or doc_id is null")
    model = fit_ngram_model(train, shard_tokens)
    assert (len(model.tries) > 1) == (shard_tokens < 10**9)
    true = BruteForce([text for key, text in edge_rows if key is None or key % 2])
    assert (model.tokens, model.words, model.texts) == (true.total, len(true.words), true.texts)
    found = score_documents(edge_docs, model).collect()
    assert len(found) == len(edge_rows)
    texts = {key: text for key, text in edge_rows if key is not None}
    for row in found:
        if row["doc_id"] is None:
            continue
        tokens = tokens_of(texts[row["doc_id"]])
        base, score = true.scores(texts[row["doc_id"]])
        assert row["n_tokens"] == len(tokens)
        assert row["n_known"] == sum(true.words[token] > 0 for token in tokens)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        if shard_tokens == 10**9:  # discounts are estimated per trie
            assert row["score"] == pytest.approx(score, abs=0.03 * len(tokens))
    by_text = {}
    for row in found:
        if row["doc_id"] in texts:
            assert by_text.setdefault(texts[row["doc_id"]], row["score"]) == row["score"]


def test_learned_texts_score_better_than_their_words_alone(edge_docs):
    model = fit_ngram_model(edge_docs)
    row = score_documents(edge_docs.where("doc_id = 8"), model).first()
    assert row["score"] > row["base_score"]


def test_empty_training_and_empty_table(edge_docs, no_docs):
    model = fit_ngram_model(no_docs)
    rows = score_documents(edge_docs, model).collect()
    assert all(row["n_known"] == 0 and row["score"] == row["base_score"] == 0 for row in rows)
    assert score_documents(no_docs, fit_ngram_model(edge_docs)).count() == 0


def test_probabilities_of_a_context_add_up(spark):
    texts = ["a b a b c", "a c a a b", "b b c"]
    rows = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "doc_id long, text string")
    model = fit_ngram_model(rows)
    true = BruteForce(texts)
    # what follows "a b": every known word, the end, and any unknown word
    total = 0.0
    for word in ["a", "b", "c", "unseen"]:
        total += true.probability(["begin of text", "a", "b", word], 3)[1]
    total += true.probability(["begin of text", "a", "b", None], 3)[1]
    assert total == pytest.approx(1.0)
    probe = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert score_documents(probe, model).first()["score"] == pytest.approx(true.scores("a b c")[1], abs=0.05)


@pytest.mark.parametrize("top", [0, 5, 1_000, 10**7])
def test_monotone_sequences_come_back(top):
    draw = np.random.default_rng(top)
    values = np.sort(draw.integers(0, top + 1, 3_000))
    code = encode_monotone(values)
    at = draw.integers(0, len(values), 5_000)
    assert (monotone_at(code, np.sort(at)) == values[np.sort(at)]).all()
    assert (monotone_at(code, at) == values[at]).all()


def test_trie_finds_what_is_there_alone():
    draw = np.random.default_rng(4)
    pairs = np.unique(draw.integers(0, 70_000, (4_000, 2)) % [50, 70_000], axis=0)
    contexts = np.sort(draw.integers(0, len(pairs), 9_000))
    triples = np.unique(np.stack([contexts, draw.integers(0, 70_000, 9_000)], axis=1), axis=0)
    ones = np.ones(len(pairs), dtype=np.int64)
    arrays, roots, _ = build_trie(
        pairs[:, 0], pairs[:, 1], ones * 4, ones * 9, triples[:, 0], triples[:, 1], np.ones(len(triples), np.int64), 70_000
    )
    trie = Trie(arrays)
    assert (trie.pairs(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    assert (trie.triples(triples[:, 0], triples[:, 1]) == np.arange(len(triples))).all()
    probes = draw.integers(0, 70_000, (4_000, 2)) % [60, 70_001]
    known = {tuple(pair): at for at, pair in enumerate(pairs.tolist())}
    assert trie.pairs(probes[:, 0], probes[:, 1]).tolist() == [known.get(tuple(one), -1) for one in probes.tolist()]
    assert roots.tolist() == sorted(set(pairs[:, 0].tolist()))


def test_scale_is_close():
    values = np.exp(np.linspace(-15, 0, 10_000))
    codes, scale = encode_scale(values)
    assert np.abs(np.log10(scale[codes] / values)).max() < 0.014
    assert len(encode_scale(values[:0])[0]) == 0


def test_packed_numbers_come_back():
    values = np.arange(0, 10**6, 37)
    assert (_unpacked(_packed(values), len(values)) == values).all()
    assert len(_unpacked(_packed(values[:0], "<u8"), 0, "<u8")) == 0
