"""Second scoring of few candidates per question."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from passagemill.functions.text import terms


def _best(scored: DataFrame, n: int, query_id: str, id_: str) -> DataFrame:
    order = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(id_))
    return scored.withColumn("rank", F.row_number().over(order).cast(LongType())).where(
        F.col("rank") <= n
    )


def shared_terms(question: Column, passage: Column) -> Column:
    return F.array_intersect(terms(question), terms(passage))


def rerank_overlap(
    candidates: DataFrame,
    term_counts: DataFrame,
    documents: Column,
    n: int = 3,
    query_id: str = "query_id",
    query: str = "query",
    id_: str = "id",
    content: str = "content",
) -> DataFrame:
    """Candidates re-ranked by the summed rarity of the terms they share with the question.

    ``term_counts`` is ``document_frequency`` of the corpus, or a stored copy of it; ``documents``
    is the number of corpus rows. Only few (candidate, term) rows meet the one row per term.
    """
    pairs = candidates.select(query_id, id_, query, content)
    shared = pairs.select(
        query_id, id_, F.explode(shared_terms(F.col(query), F.col(content))).alias("term")
    )
    rarity = F.log(1 + (documents - F.col("doc_count") + 0.5) / (F.col("doc_count") + 0.5))
    sums = (
        shared.join(term_counts, "term")
        .groupBy(query_id, id_)
        .agg(F.round(F.sum(rarity), 6).alias("score"))
    )
    scored = pairs.join(sums, [query_id, id_], "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )
    return _best(scored, n, query_id, id_).select(query_id, "rank", id_, "score", content)


def rerank_with(
    candidates: DataFrame,
    scorer,
    n: int = 3,
    batch: int = 150,
    query_id: str = "query_id",
    query: str = "query",
    id_: str = "id",
    content: str = "content",
) -> DataFrame:
    """Candidates re-ranked by a model that scores (question, passage) pairs."""

    def make():
        predict = scorer.make()

        def score(queries: np.ndarray, passages: np.ndarray) -> np.ndarray:
            return np.asarray(predict(list(queries), list(passages)), dtype=np.float64)

        return score

    call = predict_batch_udf(make, return_type=DoubleType(), batch_size=batch).asNondeterministic()
    scored = candidates.select(query_id, id_, query, content).withColumn(
        "score", F.round(call(F.col(query), F.col(content)), 6)
    )
    return _best(scored, n, query_id, id_).select(query_id, "rank", id_, "score", content)
