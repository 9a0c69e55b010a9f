"""Shared parts of the two scan searches.

If the questions are few enough to be broadcast (``fits_broadcast``), the base stays where it is: every
task walks through its own rows with all questions, keeps the best k per question and hands those on
(``scanned``). Otherwise the base is dealt into groups of a given size and the questions into blocks of a
given size, and every group meets every block of its cell in one task, through an equi-join on their
numbers (``met``); then neither side passes the driver. Both ways lead to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from passagemill.session import stage

SCORE_DIGITS = 6

#: Rows of the base that one task holds.
GROUP_ROWS = 50_000

#: More partitions than this are not asked for in a search whose questions are dealt.
MOST_PARTITIONS = 4_096

#: Questions are broadcast up to this size; all of them together are then in each Python worker once.
BROADCAST_BYTES = 64_000_000

#: Best rows of the tasks are merged within so many parts before they are ranked, so that one question's
#: rows from very many tasks do not meet in one task.
MERGE_PARTS = 64


class BestRows:
    """The best k rows per question seen so far in a task, by row number.

    Candidates are gathered and sorted in from time to time. ``floor`` is each question's k-th
    score as of the last sort; rows below it need not be offered. Equal scores rank by row number.
    """

    def __init__(self, questions: int, k: int):
        self.k = k
        self.floor = np.full(questions, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.sort_at = max(50_000, 2 * questions * k)

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if len(query):
            self.parts.append((query, score, row))
            self.waiting += len(query)
        if self.waiting >= self.sort_at:
            self.sort()

    def sort(self) -> None:
        if not self.parts:
            return
        query, score, row = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((row, -score, query))
        grouped = query[order]
        place = np.arange(len(order)) - np.searchsorted(grouped, grouped, side="left")
        order, place = order[place < self.k], place[place < self.k]
        query, score, row = query[order], score[order], row[order]
        last = place == self.k - 1
        self.floor[query[last]] = score[last]
        self.parts = [(query, score, row)]
        self.waiting = 0

    def table(self, query_ids: pa.Array, ids: pa.Array, schema: pa.Schema) -> pa.Table:
        self.sort()
        if not self.parts:
            return schema.empty_table()
        query, score, row = self.parts[0]
        columns = [query_ids.take(pa.array(query)), ids.take(pa.array(row)), pa.array(score)]
        return pa.Table.from_arrays(
            [column.cast(field.type) for column, field in zip(columns, schema)], schema=schema
        )


def candidates(
    scores: np.ndarray, floor: np.ndarray, k: int, slack: float = 0.0
) -> tuple[np.ndarray, np.ndarray]:
    """(question, row) positions that may be among the best k; ties at the border are all kept.

    ``scores`` is questions by rows; a score of -inf or NaN is never a candidate. ``slack`` is the
    largest error of a score times two.
    """
    rows = scores.shape[1]
    scores = np.where(np.isnan(scores), -np.inf, scores)
    if rows > k:
        border = np.partition(scores, rows - k, axis=1)[:, rows - k]
        floor = np.maximum(floor, border)
    return np.nonzero((scores >= floor[:, None] - slack) & (scores > -np.inf))


def hit_schema(queries: DataFrame, query_id: str, base: DataFrame, base_id: str) -> StructType:
    return StructType(
        [
            StructField(query_id, queries.schema[query_id].dataType),
            StructField("id", base.schema[base_id].dataType),
            StructField("score", DoubleType()),
        ]
    )


def unique_questions(queries: DataFrame, query_id: str) -> None:
    """Refuse questions that share a key: their rankings could not be told apart."""
    shared = queries.groupBy(query_id).count().where("count > 1")
    if not shared.isEmpty():
        raise ValueError(f"{query_id} is not unique")


class TaskBest:
    """The best k rows per question over all batches of a task, with their ids.

    ``floor`` is each question's k-th score as of the last cut; rows below it need not be offered.
    """

    def __init__(self, questions: int, k: int):
        self.k = k
        self.floor = np.full(questions, -np.inf)
        self.held: pa.Table | None = None
        self.parts: list[pa.Table] = []
        self.waiting = 0
        self.cut_at = max(50_000, 2 * questions * k)

    def add(self, question: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        if len(question):
            part = {"question": pa.array(question), "score": pa.array(score), "id": ids}
            self.parts.append(pa.table(part))
            self.waiting += len(question)
        if self.waiting >= self.cut_at:
            self.cut()

    def cut(self) -> None:
        if not self.parts:
            return
        rows = pa.concat_tables(self.parts if self.held is None else [self.held, *self.parts])
        keys = [("question", "ascending"), ("score", "descending"), ("id", "ascending")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=keys))
        question = rows.column("question").to_numpy()
        place = np.arange(len(question)) - np.searchsorted(question, question, side="left")
        self.held = rows.filter(pa.array(place < self.k))
        last = place == self.k - 1
        self.floor[question[last]] = rows.column("score").to_numpy()[last]
        self.parts, self.waiting = [], 0


def fits_broadcast(questions: DataFrame, row_bytes: int) -> bool:
    """Whether written ``questions`` may be broadcast. Counting them reads no column."""
    return questions.count() * row_bytes <= BROADCAST_BYTES


def scanned(
    questions: DataFrame,
    base: DataFrame,
    query_id: str,
    base_id: str,
    offer: Callable[[pa.Table, pa.RecordBatch, np.ndarray, TaskBest], None],
    schema: StructType,
    k: int,
    cells: str | None = None,
) -> DataFrame:
    """The best rows of every task of ``base`` for each question; ``base`` is not shuffled.

    ``offer`` puts the candidates of one batch of rows into the task's best, for the questions with the
    given numbers. With ``cells``, the name of the questions' list of cells, a question only meets the
    rows whose ``cell`` is in it. The questions' size has been looked at by the caller.
    """
    spark = base.sparkSession
    shared = spark.sparkContext.broadcast(questions.toArrow().combine_chunks())

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        everyone = np.arange(asked.num_rows)
        if cells is not None:
            lists = asked.column(cells).combine_chunks()
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            probed = np.asarray(lists.flatten()).astype(np.int64)
            who = np.repeat(everyone, lengths)
            order = np.argsort(probed, kind="stable")
            probed, who = probed[order], who[order]
        best = TaskBest(asked.num_rows, k)
        for batch in batches:
            if cells is None:
                offer(asked, batch, everyone, best)
                continue
            of_row = np.asarray(batch.column("cell"))
            for cell in np.unique(of_row):
                low, high = np.searchsorted(probed, [cell, cell + 1])
                if low < high:
                    rows = pa.array(np.flatnonzero(of_row == cell))
                    offer(asked, batch.take(rows), who[low:high], best)
        best.cut()
        if best.held is not None:
            found = best.held
            names = asked.column(query_id).take(found.column("question"))
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            columns = [names, found.column("id"), found.column("score")]
            table = pa.Table.from_arrays(
                [column.cast(field.type) for column, field in zip(columns, arrow)], schema=arrow
            )
            yield from table.to_batches()

    return merged(base.mapInArrow(best_of_task, schema), query_id, k)


def merged(hits: DataFrame, query_id: str, k: int) -> DataFrame:
    """The best k hits per question within each of ``MERGE_PARTS`` parts of the tasks."""
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("_part")
    order = [F.col("score").desc(), F.col("id")]
    rank = F.row_number().over(Window.partitionBy(query_id, "_part").orderBy(*order))
    return (
        hits.select("*", part).withColumn("_rank", rank).where(F.col("_rank") <= k).select(*hits.columns)
    )


def ranked(hits: DataFrame, query_id: str, k: int) -> DataFrame:
    """The best k hits per question; equal scores rank by id."""
    order = [F.col("score").desc(), F.col("id")]
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(*order))
    return (
        hits.withColumn("rank", rank.cast(LongType()))
        .where(F.col("rank") <= k)
        .select(query_id, "rank", "id", "score")
    )


def one_cell(key: str) -> Column:
    """Cell 0 for every row, for a search of the whole base. It is no constant, so that the cell stays
    a join key."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")


def sorted_rows(table: pa.Table, key: str) -> pa.Table:
    """A group's rows in the order of their ids, so that row numbers rank like ids."""
    return table.take(pc.sort_indices(table, sort_keys=[(key, "ascending")])).combine_chunks()


def met(
    questions: DataFrame,
    base: DataFrame,
    query_id: str,
    base_id: str,
    score: Callable[[pa.Table, pa.Table, pa.Schema], pa.Table],
    schema: StructType,
    block_rows: int,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``score`` of every block of questions with every group of rows of the same ``cell``.

    Both sides carry ``cell``. How many groups and blocks a cell has is counted first, so a large
    cell, or one that many questions ask for, is split like the others.
    """

    def sizes(rows: DataFrame, size: int, name: str) -> DataFrame:
        parts = F.ceil(F.count("*") / F.lit(float(size))).cast("int")
        return rows.groupBy("cell").agg(parts.alias(name))

    # one row per cell
    shape = stage(
        sizes(base, group_rows, "groups").join(sizes(questions, block_rows, "blocks"), "cell"),
        "search-shape",
    )

    def dealt(rows: DataFrame, key: str, own: str, count: str, other: str, others: str) -> DataFrame:
        return (
            rows.join(shape, "cell")
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(count)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
            .drop("groups", "blocks")
        )

    asked = dealt(questions, query_id, "_block", "blocks", "_group", "groups")
    held = dealt(base, base_id, "_group", "groups", "_block", "blocks")
    together = ["cell", "_group", "_block"]
    # By bytes Spark would make few partitions, but what takes time is each group with each block.
    pairs = F.sequence(F.lit(1).cast("bigint"), F.col("groups").cast("bigint") * F.col("blocks"))
    parts = min(max(2 * shape.select(F.explode(pairs)).count(), 1), MOST_PARTITIONS)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        return score(left.combine_chunks(), sorted_rows(right, base_id), arrow)

    left, right = (side.repartition(parts, *together) for side in (asked, held))
    return left.groupBy(*together).cogroup(right.groupBy(*together)).applyInArrow(run, schema)
