"""Nearest chunks for a table of question vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from passagemill.functions.vectors import vector_fault
from passagemill.operators.embed import run_once
from passagemill.operators.topk import (
    SCORE_DIGITS,
    BestRows,
    TaskBest,
    candidates,
    fits_broadcast,
    hit_schema,
    met,
    one_cell,
    ranked,
    scanned,
    unique_questions,
)
from passagemill.session import stage

METRICS = ("cosine", "l2", "dot")
#: Questions that one task holds. Each group of base rows is sent once for each block of them.
BLOCK_QUESTIONS = 65_536
#: Size bound of one score matrix, questions in one, and numbers of the pairs that are scored at once.
SCORE_CELLS = 2_000_000
QUESTION_STEP = 1_024
PAIR_CELLS = 1_000_000
#: Scores may differ by this and be equal when rounded.
SCORE_SLACK = 2 * 10.0**-SCORE_DIGITS
#: Longer vectors are not multiplied in single precision.
SINGLE_LIMIT = 1e15


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """A list column, all of width ``dim``, as doubles; a null element becomes NaN."""
    return _held(vectors, dim).astype(np.float64)


def _held(vectors: pa.Array, dim: int) -> np.ndarray:
    """Like ``matrix``, but single precision stays as it is."""
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if values.dtype != np.float32:
        values = values.astype(np.float64)
    return values.reshape(-1, dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms == 0, 1.0, norms)


def _score(questions: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Questions by rows; larger is nearer. Cosine inputs are unit vectors already."""
    products = questions @ rows.T
    if metric == "l2":
        squares = (questions**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1)[None, :]
        return -np.sqrt(np.maximum(squares - 2 * products, 0))
    return products


def _pair_scores(questions: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """The scores of questions and rows that stand side by side, in doubles, rounded."""
    questions, rows = questions.astype(np.float64), rows.astype(np.float64)
    if metric == "cosine":
        questions, rows = _unit(questions), _unit(rows)
    if metric == "l2":
        gaps = questions - rows
        scores = -np.sqrt((gaps * gaps).sum(axis=1))
    else:
        scores = (questions * rows).sum(axis=1)
    return np.round(scores, SCORE_DIGITS) + 0.0


class _Side:
    """Vectors as they are held, and as factors of keys in single precision.

    Of one question, rows with larger keys are nearer: a key is the product, of unit vectors for
    ``cosine``, and for ``l2`` the product less half the row's square. ``sizes`` are the lengths of
    what is multiplied.
    """

    def __init__(self, vectors: np.ndarray, metric: str, asks: bool):
        self.vectors = vectors
        self.sizes = np.zeros(len(vectors))
        self.keys = np.empty((len(vectors), vectors.shape[1] + (metric == "l2")), dtype=np.float32)
        step = max(1, PAIR_CELLS // vectors.shape[1])
        for at in range(0, len(vectors), step):
            part = vectors[at : at + step].astype(np.float64)
            if metric == "cosine":
                part = _unit(part)
            squares = (part * part).sum(axis=1)
            # the keys of a vector with NaN are NaN and reach no floor
            self.sizes[at : at + step] = np.where(np.isnan(part).any(axis=1), 0, np.sqrt(squares))
            with np.errstate(over="ignore"):
                self.keys[at : at + step, : vectors.shape[1]] = part
                if metric == "l2":
                    self.keys[at : at + step, -1] = 1.0 if asks else -squares / 2


class _Found:
    """Candidates of some questions among some rows, with scores in doubles."""

    def __init__(self, asked: _Side, held: _Side, metric: str, k: int, best: BestRows):
        self.asked, self.held, self.metric, self.k, self.best = asked, held, metric, k, best

    def look(self, first: int, last: int, begin: int, end: int) -> None:
        sizes, longest = self.asked.sizes[first:last], self.held.sizes[begin:end].max(initial=0)
        if not sizes.max(initial=0) + longest < SINGLE_LIMIT:
            return self.offer_all(first, last, begin, end)
        keys = self.asked.keys[first:last] @ self.held.keys[begin:end].T
        width = end - begin
        most = sizes * longest + (longest**2 if self.metric == "l2" else 0)
        error = (self.asked.keys.shape[1] + 8) * np.finfo(np.float32).eps * most + 1e-30
        floor = self.best.floor[first:last]
        near = self.reaching(keys, floor, sizes, error)
        if len(near) > keys.size // 16 and width > self.k:
            border = np.partition(keys, width - self.k, axis=1)[:, width - self.k] - error
            if self.metric == "l2":
                border = -np.sqrt(np.maximum(sizes**2 - 2 * border, 0))
            # at least k rows score as much, so this is a floor from now on
            np.maximum(floor, border, out=floor)
            near = self.reaching(keys, floor, sizes, error)
        self.offer(near // width + first, near % width + begin)

    def reaching(
        self, keys: np.ndarray, floor: np.ndarray, sizes: np.ndarray, error: np.ndarray
    ) -> np.ndarray:
        """Places of the keys of which nothing shows that they are below the floor."""
        floor = floor - SCORE_SLACK
        if self.metric == "l2":
            floor = (sizes**2 - np.where(floor < 0, floor, 0) ** 2) / 2
        least = np.nextafter((floor - error).astype(np.float32), np.float32(-np.inf))
        return np.flatnonzero((keys >= least[:, None]).ravel())

    def offer_all(self, first: int, last: int, begin: int, end: int) -> None:
        """Vectors beyond single precision: all pairs are scored in doubles."""
        rows = np.arange(begin, end)
        for question in range(first, last):
            self.offer(np.full(len(rows), question), rows)

    def offer(self, question: np.ndarray, row: np.ndarray) -> None:
        step = max(1, PAIR_CELLS // max(1, self.asked.vectors.shape[1]))
        for at in range(0, len(question), step):
            q, r = question[at : at + step], row[at : at + step]
            score = _pair_scores(self.asked.vectors[q], self.held.vectors[r], self.metric)
            kept = (score >= self.best.floor[q] - SCORE_SLACK) & (score > -np.inf)
            self.best.add(q[kept], score[kept], r[kept])


def _best(
    asked: _Side, rows: np.ndarray, metric: str, k: int, floor: np.ndarray | None = None
) -> BestRows:
    """The best rows of one group for one block of questions, of those that reach its ``floor``.

    Keys in single precision, with a bound on their error, rule out nearly all pairs; only the others
    are scored in doubles. Memory is that of one matrix of ``SCORE_CELLS`` keys and of the candidates.
    """
    best = BestRows(len(asked.vectors), k)
    if floor is not None:
        best.floor[:] = floor
    # a vector with a null or NaN element scores NaN, which is never a hit
    places = np.flatnonzero(~np.isnan(rows).any(axis=1))
    whole = len(places) == len(rows)
    held = _Side(rows if whole else rows[places], metric, asks=False)
    found = _Found(asked, held, metric, k, best)
    step = max(1, SCORE_CELLS // QUESTION_STEP)
    for first in range(0, len(asked.vectors), QUESTION_STEP):
        last = min(first + QUESTION_STEP, len(asked.vectors))
        for begin in range(0, len(held.vectors), step):
            found.look(first, last, begin, min(begin + step, len(held.vectors)))
    if not whole:
        best.sort()
        best.parts = [(query, score, places[row]) for query, score, row in best.parts]
    return best


def question_faults(queries: DataFrame, dim: int, query_vector: str = "embedding") -> DataFrame:
    """Questions that a search of this width cannot answer, with the reason in ``fault``."""
    fault = vector_fault(F.col(query_vector), dim)
    return queries.withColumn("fault", fault).where(F.col("fault").isin("null", "width"))


def _scan(
    asked: DataFrame,
    held: DataFrame,
    k: int,
    metric: str,
    dim: int,
    query_id: str,
    base_id: str,
    schema,
    cells: str | None,
) -> DataFrame:
    """Broadcast questions (query id, ``_asked``, list of cells) over base rows in place."""

    everyone: list[_Side] = []  # the questions of a task, made at its first batch

    def side(questions: pa.Table, numbers: np.ndarray) -> _Side:
        some = questions.column("_asked").combine_chunks()
        if len(numbers) < len(some):
            return _Side(_held(some.take(pa.array(numbers)), dim), metric, asks=True)
        if not everyone:
            everyone.append(_Side(_held(some, dim), metric, asks=True))
        return everyone[0]

    def offer(questions: pa.Table, batch: pa.RecordBatch, numbers: np.ndarray, best: TaskBest) -> None:
        ids = batch.column(base_id)
        by_id = pc.sort_indices(ids)  # so that row numbers rank like ids
        rows = _held(batch.column("_held").take(by_id), dim)
        found = _best(side(questions, numbers), rows, metric, k, best.floor[numbers])
        found.sort()
        if found.parts:
            question, score, row = found.parts[0]
            best.add(numbers[question], score, ids.take(by_id).take(pa.array(row)))

    return scanned(asked, held, query_id, base_id, offer, schema, k, cells)


def _dealt(
    questions: DataFrame,
    base: DataFrame,
    k: int,
    metric: str,
    dim: int,
    query_id: str,
    base_id: str,
    block_rows: int,
    schema,
) -> DataFrame:
    """Questions (query id, vector, cell) with base rows (id, vector, cell) of the same cell."""

    def score(asked: pa.Table, held: pa.Table, arrow: pa.Schema) -> pa.Table:
        questions = _Side(_held(asked.column("_asked").combine_chunks(), dim), metric, asks=True)
        best = _best(questions, _held(held.column("_held").combine_chunks(), dim), metric, k)
        return best.table(asked.column(query_id), held.column(base_id), arrow)

    return met(questions, base, query_id, base_id, score, schema, block_rows)


def vector_topk(
    queries: DataFrame,
    base: DataFrame,
    dim: int,
    k: int = 5,
    metric: str = "cosine",
    query_id: str = "query_id",
    query_vector: str = "embedding",
    base_id: str = "id",
    base_vector: str = "embedding",
    block_rows: int = BLOCK_QUESTIONS,
) -> DataFrame:
    """Exact k nearest base rows per question: query id, rank (from 1), id, score.

    ``dim`` is the vectors' width. Questions of another width are never answered and listed by
    ``question_faults``; ``check_vectors`` lists such rows of the base. ``l2`` scores are negative
    distances. Scores are rounded to six digits before ranking and equal scores rank by id. Only id
    and vector are read from ``base``; ``with_columns`` adds others.
    """
    return vector_topk_in_cells(
        queries.select(query_id, query_vector, F.array(one_cell(query_id)).alias("_cells")),
        base.select(base_id, base_vector, one_cell(base_id).alias("_cell")),
        dim,
        k,
        metric,
        query_id,
        query_vector,
        base_id,
        base_vector,
        F.col("_cells"),
        "_cell",
        block_rows,
    )


def vector_topk_in_cells(
    queries: DataFrame,
    base: DataFrame,
    dim: int,
    k: int,
    metric: str,
    query_id: str,
    query_vector: str,
    base_id: str,
    base_vector: str,
    cells: Column,
    cell: str,
    block_rows: int = BLOCK_QUESTIONS,
) -> DataFrame:
    """Like ``vector_topk``, but a question only meets the rows of its own ``cells``."""
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    schema = hit_schema(queries, query_id, base, base_id)
    chosen = queries.select(query_id, F.col(query_vector).alias("_asked"), cells.alias("_cells"))
    written = stage(chosen, "questions")
    unique_questions(written, query_id)
    asked = written.where(F.size("_asked") == dim)
    # A vector with a null or NaN element scores NaN, which is never a candidate.
    held = base.where(F.size(base_vector) == dim).select(
        base_id, F.col(base_vector).alias("_held"), F.col(cell).alias("cell")
    )
    if fits_broadcast(written, 8 * dim + 64):
        hits = _scan(asked, held, k, metric, dim, query_id, base_id, schema, "_cells")
    else:
        each = asked.select(query_id, "_asked", F.explode("_cells").alias("cell"))
        hits = _dealt(each, held, k, metric, dim, query_id, base_id, block_rows, schema)
    return ranked(hits, query_id, k)


def cell_order(questions: np.ndarray, centroids: np.ndarray, metric: str) -> np.ndarray:
    """Cells per question, nearest first. Cells come from k-means, so nearness is distance, except
    that the dot product looks for large products."""
    if metric == "cosine":
        questions = _unit(questions)
    nearness = _score(questions, centroids, "dot" if metric == "dot" else "l2")
    return np.argsort(-nearness, axis=1, kind="stable")


def probe_order(vector: Column, centroids: np.ndarray, metric: str, probes: int) -> Column:
    """The ``probes`` nearest cells, nearest first; none for a vector of another width."""
    dim = centroids.shape[1]

    def order(vectors: pa.Array) -> pa.Array:
        widths = np.asarray(vectors.value_lengths().fill_null(0))
        usable = np.flatnonzero(widths == dim)
        rows = matrix(vectors.take(pa.array(usable)), dim)
        step = max(1, SCORE_CELLS // len(centroids))
        parts = [
            cell_order(rows[at : at + step], centroids, metric)[:, :probes]
            for at in range(0, len(rows), step)
        ]
        cells = np.concatenate(parts) if parts else np.zeros((0, probes), dtype=np.int64)
        counts = np.zeros(len(vectors) + 1, dtype=np.int32)
        counts[usable + 1] = cells.shape[1]
        return pa.ListArray.from_arrays(
            pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(cells.ravel().astype(np.int32))
        )

    return run_once(order, ArrayType(IntegerType()))(vector)


def with_columns(
    hits: DataFrame, base: DataFrame, columns: Sequence[str], base_id: str = "id"
) -> DataFrame:
    """Add wide columns of the base to hits found by id.

    The hits are written first: the search then runs once, and Spark knows their size. Small hits
    are broadcast, so the wide columns are read in one pass without a shuffle; hits above Spark's
    broadcast threshold are joined by a shuffle on id.
    """
    hits = stage(hits, "hits")
    wide = base.select(F.col(base_id).alias("id"), *columns)
    return hits.join(wide, "id").select(*hits.columns, *columns)


def passages(hits: DataFrame, file: str = "pdf_name", text: str = "content") -> DataFrame:
    """Search rows as named (file, text) records."""
    kept = [name for name in hits.columns if name not in (file, text)]
    return hits.select(*kept, F.col(file).alias("file"), F.col(text).alias("text"))
