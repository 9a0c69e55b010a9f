"""Keyword search over a table of texts, ranked by BM25."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.functions.text import terms, truncated
from passagemill.operators import topk
from passagemill.operators.topk import (
    SCORE_DIGITS,
    BestRows,
    TaskBest,
    candidates,
    hit_schema,
    met,
    one_cell,
    ranked,
    scanned,
    unique_questions,
)
from passagemill.operators.vector_search import with_columns
from passagemill.session import stage

# The usual BM25 constants.
K1 = 1.2
B = 0.75
# Questions that one task holds, and the size bound of one score matrix in it.
BLOCK_QUESTIONS = 256
SCORE_CELLS = 2_000_000
# More questions than this are not broadcast: each task holds their weights as tables.
SCANNED_QUESTIONS = 4_096


def document_frequency(docs: DataFrame, text: str = "content") -> DataFrame:
    """In how many rows each term occurs. Counted per task first, so common terms do not pile up."""
    return (
        docs.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("doc_count"))
    )


def corpus_totals(docs: DataFrame, text: str = "content") -> DataFrame:
    """One row: rows with a text, and terms in all of them."""
    return docs.where(F.col(text).isNotNull()).agg(
        F.count("*").alias("rows"), F.sum(F.size(terms(F.col(text)))).alias("terms")
    )


def _coded(term_lists: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term code) of every term that is in the vocabulary, and all rows' lengths."""
    lengths = np.asarray(term_lists.value_lengths().fill_null(0))
    codes = pc.index_in(term_lists.flatten(), value_set=vocabulary)
    known = np.asarray(pc.is_valid(codes))
    rows = np.repeat(np.arange(len(term_lists)), lengths)[known]
    return rows, np.asarray(pc.drop_null(codes)).astype(np.int64), lengths


class _Questions:
    """A block of questions as a table of weights: distinct terms by questions."""

    def __init__(self, lists: pa.Array, weights: pa.Array):
        self.vocabulary = lists.flatten().unique()
        question, term, _ = _coded(lists, self.vocabulary)
        self.rarity = np.zeros((len(self.vocabulary), len(lists)))
        self.rarity[term, question] = weights.flatten().to_numpy(zero_copy_only=False)

    def best(
        self, texts: pa.Array, mean_length: float, k: int, floor: np.ndarray | None = None
    ) -> BestRows:
        """The best of the texts, in the order of their ids, of those that reach the ``floor``."""
        best = BestRows(self.rarity.shape[1], k)
        if floor is not None:
            best.floor[:] = floor
        size = len(self.vocabulary)
        step = max(1, SCORE_CELLS // max(1, max(self.rarity.shape)))
        for at in range(0, len(texts), step):
            part = texts.slice(at, step)
            rows, codes, lengths = _coded(part, self.vocabulary)
            cells = np.bincount(rows * size + codes, minlength=len(part) * size)
            counts = cells.reshape(len(part), size).astype(np.float64)
            pressed = K1 * (1 - B + B * lengths / mean_length)
            gain = counts * (K1 + 1) / (counts + pressed[:, None])
            exact = (gain @ self.rarity).T
            # every shared term adds something, however little is left of it after rounding
            scores = np.where(exact > 0, np.round(exact, SCORE_DIGITS), -np.inf)
            chosen, row = candidates(scores, best.floor, k)
            best.add(chosen, scores[chosen, row], row + at)
        return best


def keyword_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 3,
    query_id: str = "query_id",
    query_text: str = "query",
    doc_id: str = "id",
    doc_text: str = "content",
    block_questions: int = BLOCK_QUESTIONS,
    term_counts: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The k best rows per question by BM25 over distinct question terms: rank from 1, id, score.

    Rows without any question term are no hits. How many rows hold a question's terms is counted
    first, unless stored copies of ``document_frequency`` and ``corpus_totals`` are given.
    """
    if (term_counts is None) != (totals is None):
        raise ValueError("term_counts and totals go together")
    unique_questions(queries, query_id)
    asked = queries.select(
        query_id, F.explode(F.array_distinct(terms(F.col(query_text)))).alias("term")
    )
    # The filter is on the text: on the terms it would find them a second time.
    corpus = docs.where(F.col(doc_text).isNotNull()).select(
        doc_id, terms(F.col(doc_text)).alias("terms")
    )
    words = asked.select("term").distinct()
    if term_counts is None:
        held = corpus.select(F.explode(F.array_distinct("terms")).alias("term"))
        term_counts = (
            held.join(words, "term", "left_semi")
            .groupBy("term")
            .agg(F.count("*").alias("doc_count"))
        )
        totals = corpus.agg(F.count("*").alias("rows"), F.sum(F.size("terms")).alias("terms"))
    rows, length = totals.select("rows", "terms").first()
    held_by = F.coalesce("doc_count", F.lit(0))
    weight = F.log(1 + (F.lit(float(rows)) - held_by + 0.5) / (held_by + 0.5))
    weighed = (
        asked.join(term_counts.join(words, "term", "left_semi"), "term", "left")
        .groupBy(query_id)
        .agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("weight")))).alias("_all"))
        .select(
            query_id,
            F.col("_all.term").alias("terms"),
            F.col("_all.weight").alias("weights"),
            F.lit(0).alias("cell"),
        )
    )
    mean_length = max((length or 0) / max(rows, 1), math.ulp(1.0))

    schema = hit_schema(queries, query_id, docs, doc_id)
    written = stage(weighed, "question-weights")
    if _few_enough(written):
        texts = corpus.select(doc_id, "terms")
        hits = _scan(written, texts, mean_length, k, query_id, doc_id, schema, block_questions)
    else:

        def score(left: pa.Table, right: pa.Table, arrow: pa.Schema) -> pa.Table:
            lists, weights = (left.column(name).combine_chunks() for name in ("terms", "weights"))
            texts = right.column("terms").combine_chunks()
            best = _Questions(lists, weights).best(texts, mean_length, k)
            return best.table(left.column(query_id), right.column(doc_id), arrow)

        placed = corpus.withColumn("cell", one_cell(doc_id))
        hits = met(written, placed, query_id, doc_id, score, schema, block_questions)
    return ranked(hits, query_id, k)


def _few_enough(questions: DataFrame) -> bool:
    """Whether the questions may be broadcast: their number and the bytes of their terms."""
    letters = F.aggregate("terms", F.lit(0), lambda total, term: total + F.octet_length(term) + 16)
    asked, size = questions.agg(F.count("*"), F.sum(letters)).first()
    return asked <= SCANNED_QUESTIONS and (size or 0) <= topk.BROADCAST_BYTES


def _scan(
    questions: DataFrame,
    corpus: DataFrame,
    mean_length: float,
    k: int,
    query_id: str,
    doc_id: str,
    schema,
    block_questions: int,
) -> DataFrame:
    """Broadcast questions over the texts in place; texts and their terms are not shuffled."""

    blocks: list[_Questions] = []  # those of a task, made at its first batch

    def offer(asked: pa.Table, batch: pa.RecordBatch, numbers: np.ndarray, best: TaskBest) -> None:
        if not blocks:
            lists, weights = (asked.column(name).combine_chunks() for name in ("terms", "weights"))
            for at in range(0, len(lists), block_questions):
                blocks.append(
                    _Questions(lists.slice(at, block_questions), weights.slice(at, block_questions))
                )
        ids = batch.column(doc_id)
        by_id = pc.sort_indices(ids)
        texts, ids = batch.column("terms").take(by_id), ids.take(by_id)
        for number, block in enumerate(blocks):
            some = numbers[number * block_questions : (number + 1) * block_questions]
            found = block.best(texts, mean_length, k, best.floor[some])
            found.sort()
            if found.parts:
                question, score, row = found.parts[0]
                best.add(some[question], score, ids.take(pa.array(row)))

    return scanned(questions, corpus, query_id, doc_id, offer, schema, k)


def keyword_lookup(
    queries: DataFrame,
    docs: DataFrame,
    max_chars: int = 100,
    query_id: str = "query_id",
    doc_id: str = "id",
    doc_text: str = "content",
    **names: str,
) -> DataFrame:
    """The single best row per question, its text cut to ``max_chars`` characters."""
    hits = keyword_topk(
        queries, docs, 1, query_id=query_id, doc_id=doc_id, doc_text=doc_text, **names
    )
    found = with_columns(hits, docs, [doc_text], doc_id)
    return found.select(
        query_id, "id", "score", truncated(F.col(doc_text), max_chars).alias("snippet")
    )


def two_hop_lookup(
    first_hits: DataFrame,
    docs: DataFrame,
    k: int = 1,
    query_id: str = "query_id",
    text: str = "content",
    doc_id: str = "id",
    doc_text: str = "content",
) -> DataFrame:
    """Search again with the best hit's text, commas removed, as the question.

    ``docs`` may be computed texts: they are written first, as the search reads them three times.
    """
    docs = stage(docs.select(doc_id, doc_text), "second-texts")
    second = first_hits.where(F.col("rank") == 1).select(
        query_id, F.replace(F.col(text), F.lit(","), F.lit("")).alias("query")
    )
    return keyword_topk(second, docs, k, query_id=query_id, doc_id=doc_id, doc_text=doc_text)
