"""Exact search for the largest inner products, with vectors processed by falling length.

The rows are put in order of their length and cut into groups; a group meets the questions block by
block, each pair of group and block in one task. Every question first meets the group of the longest
rows, which gives it a floor: the score that it has k times already. From then on a question meets a
group only if its length times the group's greatest length reaches its floor, which by Cauchy-Schwarz
no product there can exceed. Inside a task the same bound ends the walk through the rows, and pairs
that pass it are cut down by partial sums: both sides are rotated into the singular vectors of all
rows, so that the first coordinates hold most of a product, and what the rest can still add is at most
the product of the two residual lengths. What is left is multiplied in integers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from passagemill.llm.vector_rows import integer_entries, is_whole, moment_matrix, padded, widest
from passagemill.operators.topk import BestRows, candidates
from passagemill.session import stage

#: Entries (rows x width) of a group of rows and of a block of questions; both lie in one task.
GROUP_ENTRIES = 1_000_000
BLOCK_ENTRIES = 1_000_000
#: Pairs whose bounds are looked at together.
PAIRS = 400_000
#: Partial sums stop to look at the bound where the leading directions hold these shares of all squares.
SHARES = (0.3, 0.6, 0.85)
#: If more than this share of pairs passes the first bound, their whole products are taken at once.
DENSE = 0.1


@dataclass(frozen=True)
class Rotation:
    """Directions (columns) by falling singular value, and where partial sums look at the bound."""

    axes: np.ndarray
    cuts: tuple[int, ...]

    def turn(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rotated rows, and per cut the length of what comes after it."""
        turned = rows @ self.axes
        rest = [np.sqrt((turned[:, cut:] ** 2).sum(axis=1)) for cut in self.cuts]
        return turned, np.array(rest).reshape(len(self.cuts), len(rows))


def fit_rotation(rows: DataFrame, width: int) -> Rotation:
    """Right singular vectors of all rows (``x``), from the sum of their outer products."""

    def squares(batch: pa.RecordBatch) -> np.ndarray:
        x = padded(batch.column("x"), width).astype(np.float64)
        return x.T @ x

    strengths, axes = np.linalg.eigh(moment_matrix(rows.select("x"), width, squares))
    strengths, axes = np.maximum(strengths[::-1], 0), axes[:, ::-1]
    held = np.cumsum(strengths) / max(strengths.sum(), np.finfo(float).tiny)
    cuts = sorted({int(np.searchsorted(held, share)) + 1 for share in SHARES})
    return Rotation(np.ascontiguousarray(axes), tuple(cut for cut in cuts if cut < width))


def _search(
    asked: np.ndarray,
    floor: np.ndarray,
    asked_no: np.ndarray,
    held: np.ndarray,
    held_no: np.ndarray,
    place: np.ndarray,
    rotation: Rotation,
    k: int,
) -> BestRows:
    """The best rows of a group for each question of a block that reach its floor.

    ``place`` ranks rows of equal score. A row is no hit of itself (equal numbers).
    """
    by_length = np.argsort(-(held**2).sum(axis=1), kind="stable")
    held, held_no, place = held[by_length], held_no[by_length], place[by_length]
    lengths, asked_lengths = np.sqrt((held**2).sum(axis=1)), np.sqrt((asked**2).sum(axis=1))
    turned, rest = rotation.turn(held)
    asked_turned, asked_rest = rotation.turn(asked)
    best = BestRows(len(asked), k)
    best.floor[:] = floor
    step = max(1, PAIRS // max(1, len(asked)))
    at = 0
    while at < len(held):
        # what rounding can take from a bound; scores are integers
        slack = 0.25 + 1e-9 * asked_lengths * lengths[at]
        live = np.flatnonzero(asked_lengths * lengths[at] >= best.floor - slack)
        if not len(live):
            break  # the rows after this one are no longer
        rows = np.arange(at, min(at + step, len(held)))
        at += step
        wanted = (best.floor - slack)[live]
        if rotation.cuts:
            cut = rotation.cuts[0]
            sums = asked_turned[live, :cut] @ turned[rows, :cut].T
            reach = sums + asked_rest[0][live][:, None] * rest[0][rows][None, :]
        else:
            sums = reach = asked_lengths[live][:, None] * lengths[rows][None, :]
        passing = reach >= wanted[:, None]
        if passing.mean() > DENSE or not rotation.cuts:
            scores = asked[live] @ held[rows].T
            scores[asked_no[live][:, None] == held_no[rows][None, :]] = -np.inf
            q, r = candidates(scores, best.floor[live], k)
            best.add(live[q], scores[q, r], place[rows[r]])
            continue
        q, r = np.nonzero(passing)
        sums, q, r = sums[q, r], live[q], rows[r]
        for number in range(1, len(rotation.cuts)):
            low, high = rotation.cuts[number - 1], rotation.cuts[number]
            sums = sums + np.einsum("ij,ij->i", asked_turned[q, low:high], turned[r, low:high])
            may = sums + asked_rest[number][q] * rest[number][r] >= (best.floor - slack)[q]
            sums, q, r = sums[may], q[may], r[may]
        scores = np.einsum("ij,ij->i", asked[q], held[r])
        good = (scores >= best.floor[q]) & (asked_no[q] != held_no[r])
        best.add(q[good], scores[good], place[r[good]])
    return best


def _meet(asked: DataFrame, held: DataFrame, rotation: Rotation, width: int, k: int) -> DataFrame:
    """Hits of every block of questions in every group of rows with its number."""
    id_type = held.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("question", T.LongType()),
            T.StructField("query_id", id_type),
            T.StructField("id", id_type),
            T.StructField("score", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        ids = right.column("id").combine_chunks()
        place = np.empty(len(ids), dtype=np.int64)
        by_id = np.asarray(pc.sort_indices(ids, null_placement="at_end"))
        place[by_id] = np.arange(len(ids))
        best = _search(
            padded(left.column("x"), width).astype(np.float64),
            left.column("floor").to_numpy().astype(np.float64),
            left.column("row_no").to_numpy(),
            padded(right.column("x"), width).astype(np.float64),
            right.column("row_no").to_numpy(),
            place,
            rotation,
            k,
        )
        best.sort()
        if not best.parts:
            return arrow.empty_table()
        question, score, row = best.parts[0]
        limit = 2.0**63 - 1024
        return pa.table(
            {
                "question": left.column("row_no").take(pa.array(question)),
                "query_id": left.column("id").take(pa.array(question)),
                "id": ids.take(pa.array(by_id[row])),
                "score": pa.array(np.clip(score, -limit, limit).astype(np.int64)),
            }
        ).cast(arrow)

    dealt = ["group", "block"]
    held = held.toDF(*held.columns)  # columns of its own, if it was joined with the questions
    return asked.groupBy(*dealt).cogroup(held.groupBy(*dealt)).applyInArrow(run, schema)


def groups_in_reach(lengths: np.ndarray, floors: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """How many groups, by falling ``longest``, hold rows long enough for each question's floor."""
    # scores are integers, so a quarter and a billionth are room for rounding
    least = np.where(floors <= 0, -np.inf, (floors - 0.25) / np.maximum(lengths, 1e-300) * (1 - 1e-9))
    return len(longest) - np.searchsorted(longest[::-1], least, side="left")


def largest_products(
    table: DataFrame,
    is_question: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    group_entries: int = GROUP_ENTRIES,
    block_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """``query_id, rank (from 1), id, score``: the k largest products of each marked row with all others.

    Entries become ``floor(scale * entry)``; scores are exact integers up to 2**53, and beyond that
    rounded like doubles, at most the largest long. Equal scores rank by key, null keys last. Rows with a
    null vector, or one that holds null or non-finite entries, take no part. A shorter vector counts as
    carried on with zeros. Repeated rows are rows of their own, as questions and as hits; a row whose mark
    is null is no question. An empty table gives no rows. Columns of other names are never read.
    """
    marked = F.coalesce(is_question, F.lit(False)).alias("asked")
    cleaned = table.where(is_whole(F.col(vector))).select(
        F.col(key).alias("id"), marked, integer_entries(F.col(vector), scale).alias("x")
    )
    squares = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v)
    # The number of a row is written with it, so that it stays the same in all later steps.
    rows = stage(
        cleaned.select(
            "*", F.sqrt(squares).alias("length"), F.monotonically_increasing_id().alias("row_no")
        ),
        "products-rows",
    )
    n, width = widest(rows, "x")
    rotation = fit_rotation(rows, max(width, 1))
    width = max(width, 1)
    groups = max(1, -(-n * width // group_entries))
    placed = stage(
        rows.repartitionByRange(groups, F.col("length").desc(), "row_no").select(
            "*", F.spark_partition_id().alias("group")
        ),
        "products-groups",
    )
    # One length per group: a number for each ``group_entries`` entries of the input.
    shape = {
        row["group"]: row["longest"]
        for row in placed.groupBy("group").agg(F.max("length").alias("longest")).collect()
    }
    first = min(shape, default=0)
    longest, at = [], shape.get(first, 0.0)
    for group in range(max(shape, default=0) + 1):
        at = shape.get(group, at)
        longest.append(at)
    questions = placed.where("asked").select("row_no", "id", "length", "x")
    blocks = max(1, -(-questions.count() * width // block_entries))
    questions = questions.withColumn("block", F.pmod(F.xxhash64("row_no"), F.lit(blocks)).cast("int"))
    held = placed.select("row_no", "id", "x", "group")

    opening = stage(
        _meet(
            questions.select("*", F.lit(first).alias("group"), F.lit(float("-inf")).alias("floor")),
            held.where(F.col("group") == first).withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
            ),
            rotation,
            width,
            k,
        ),
        "products-opening",
    )
    floors = (
        opening.groupBy(F.col("question").alias("row_no"))
        .agg(F.count("*").alias("found"), F.min("score").cast("double").alias("least"))
        .where(F.col("found") >= k)
        .select("row_no", "least")
    )
    floor = F.coalesce("least", F.lit(float("-inf")))
    falling = np.array(longest)

    def count(lengths: pa.Array, floors: pa.Array) -> pa.Array:
        given = (np.asarray(column, dtype=np.float64) for column in (lengths, floors))
        return pa.array(groups_in_reach(*given, falling).astype(np.int32))

    in_reach = F.arrow_udf(count, "int").asNondeterministic()(F.col("length"), F.col("floor"))
    asked = (
        questions.join(floors, "row_no", "left")
        .withColumn("floor", floor)
        .withColumn("reach", in_reach)
        .where(F.col("reach") > first + 1)
        .withColumn("group", F.explode(F.sequence(F.lit(first + 1), F.col("reach") - 1)))
        .select("row_no", "id", "x", "floor", "group", "block")
    )
    asked = stage(asked, "products-asked")
    pairs = asked.select("group", "block").distinct()
    later = _meet(asked, held.join(pairs, "group"), rotation, width, k)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("question").orderBy(*order))
    return (
        opening.unionByName(later)
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
