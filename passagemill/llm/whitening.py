"""Whitening of vectors, with each distinct vector taken once and weighted by how often it occurs.

Rows are put together by their integer vector. The sums, the covariance and the whitened coordinates are
those of the distinct vectors, weighted by their counts (or by one); centring is done in integers, before
anything is multiplied. The whitened vectors are then joined back to the rows: the vectors that are
frequent, which are few by arithmetic, are broadcast, and the others meet their rows in a shuffle in which
no key is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.vector_rows import (
    integer_entries,
    is_whole,
    list_column,
    moment_matrix,
    padded,
    widest,
)
from passagemill.session import stage

#: A vector that at least one row in so many carries is frequent: there are at most so many of them.
FREQUENT = 1_000
#: An eigenvalue below this share of the greatest, times the width, is taken as zero.
ZERO_SHARE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What is learned: the fitted number and sums of entries, eigenvalues and eigenvectors (columns)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    fill: int

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def scales(self) -> np.ndarray:
        """The square roots of the eigenvalues, NaN where an eigenvalue is zero."""
        least = ZERO_SHARE * self.width * max(self.values.max(initial=0.0), 0.0)
        return np.sqrt(np.where(self.values > least, self.values, np.nan))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - sums`` exactly: longs if they suffice, else Python's integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _square_sums(deviations: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row, as a decimal."""
    width = max(deviations.shape[1], 1)
    most = 0 if not deviations.size else max(abs(int(deviations.max())), abs(int(deviations.min())))
    if deviations.dtype != object and most**2 * width < 1 << 62:
        return pa.array((deviations**2).sum(axis=1)).cast(pa.decimal128(38, 0))
    totals = (deviations.astype(object) ** 2).sum(axis=1)
    return pa.array(
        [None if total >= 10**38 else Decimal(int(total)) for total in totals], pa.decimal128(38, 0)
    )


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x, times``: the distinct vectors and their counts, pre-aggregated in each task."""
    return rows.groupBy("x").agg(F.count("*").alias("times"))


def _sums(distinct: DataFrame, weight: str, width: int, fill: int) -> tuple[int, tuple[int, ...]]:
    """Exact weighted number and per-dimension sums of all vectors."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = [0] * width, 0
        for batch in batches:
            x = padded(batch.column("x"), width, fill)
            w = batch.column(weight).to_numpy()
            most = int(np.abs(x).max(initial=0)) * int(w.sum())
            x = x if most < 1 << 62 else x.astype(object)
            total = [a + int(b) for a, b in zip(total, (x * w[:, None]).sum(axis=0))]
            number += int(w.sum())
        amounts = [Decimal(number), *map(Decimal, total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 1), pa.int32()), pa.array(amounts, pa.decimal128(38, 0))],
            names=["at", "amount"],
        )

    parts = distinct.mapInArrow(totals, "at int, amount decimal(38, 0)")
    added = parts.groupBy("at").agg(F.sum("amount").cast("decimal(38, 0)").alias("amount"))
    found = {row["at"]: int(row["amount"]) for row in added.collect()}
    return found.get(0, 0), tuple(found.get(at + 1, 0) for at in range(width))


def fit_whitening(distinct: DataFrame, weight: str, width: int, fill: int) -> Whitening:
    """Learn from all distinct vectors. The driver gets the sums and one covariance matrix.

    The covariance is a sum of weighted products of centred rows, divided by the weighted number. The
    eigenvector's greatest entry is positive.
    """
    n, sums = _sums(distinct, weight, width, fill)
    if not n or not width:
        return Whitening(n, sums, np.zeros(width), np.eye(width), 0.0, fill)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        x = _deviations(padded(batch.column("x"), width, fill), n, sums).astype(np.float64) / n
        return (x * batch.column(weight).to_numpy()[:, None]).T @ x

    covariance = moment_matrix(distinct.select("x", weight), width, products) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    greatest = axes[np.abs(axes).argmax(axis=0), np.arange(width)]
    axes = axes * np.where(greatest < 0, -1.0, 1.0)
    return Whitening(n, sums, np.maximum(values, 0), axes, float(np.trace(covariance)), fill)


def whiten_distinct(distinct: DataFrame, model: Whitening, components: int) -> DataFrame:
    """``x, times`` with ``deviation`` and the list ``whitened`` of the first components."""
    axes = model.axes[:, :components] / model.scales[:components]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviations = _deviations(padded(batch.column("x"), model.width, model.fill), model.n, model.sums)
            whitened = (deviations.astype(np.float64) / model.n) @ axes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _square_sums(deviations), list_column(whitened)],
                names=[*batch.schema.names, "deviation", "whitened"],
            )

    names = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in distinct.schema.fields)
    return distinct.mapInArrow(project, f"{names}, deviation decimal(38, 0), whitened array<double>")


def identity_error(whitened: DataFrame, weight: str, n: int, components: int) -> float:
    """The greatest distance of the whitened vectors' covariance from the identity, over the
    components that have one; 0 if none has. Measured on the written vectors, centred first."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        rows = _matrix(batch)
        out = np.zeros((components + 1, components + 1))
        out[0, 1:] = out[1:, 0] = batch.column(weight).to_numpy() @ rows
        return out

    if not components or not n:
        return 0.0

    def _matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column("whitened").flatten()).reshape(batch.num_rows, components)

    mean = moment_matrix(whitened.select("whitened", weight), components + 1, sums)[0, 1:] / n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        rows = _matrix(batch) - mean
        return (rows * batch.column(weight).to_numpy()[:, None]).T @ rows

    covariance = moment_matrix(whitened.select("whitened", weight), components, products) / n
    there = ~np.isnan(np.diag(covariance))
    gaps = np.abs(covariance - np.eye(components))[np.ix_(there, there)]
    return float(gaps.max(initial=0.0))


def _key() -> list[Column]:
    """128 bits of the vector, in two longs, to join by."""
    return [F.xxhash64(F.lit(seed), "x").alias(f"key_{seed}") for seed in (1, 2)]


def join_back(rows: DataFrame, whitened: DataFrame, n_rows: int) -> DataFrame:
    """The rows (``id, x``) with their vector's ``deviation`` and ``whitened``.

    A vector of more than one in ``FREQUENT`` rows would pile up in one task, so those, of which there
    are at most ``FREQUENT``, are broadcast; only the other rows are shuffled.
    """
    keys = ["key_1", "key_2"]
    values = whitened.select(*_key(), "times", "deviation", "whitened")
    often = F.col("times") * FREQUENT >= n_rows
    frequent = F.broadcast(values.where(often).select(*keys, F.struct("deviation", "whitened").alias("at_hand")))
    met = rows.select("id", *_key()).join(frequent, keys, "left")
    found = met.where(F.col("at_hand").isNotNull()).select("id", "at_hand.*")
    rest = met.where(F.col("at_hand").isNull()).select("id", *keys)
    others = rest.join(values.where(~often), keys).select("id", "deviation", "whitened")
    return found.unionByName(others)


def whiten(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    fit: str = "count",
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``, a row per row and component.

    Entries become ``x = floor(scale * entry) + shift``. ``fit`` says what the covariance is taken over:
    all rows (``count``) or each distinct vector once (``one``); ``n`` is its number. ``deviation`` is the
    sum of ``(n * x - S)**2`` as a decimal, null from 10**38 on. Rows with a null vector, or one that holds
    null or non-finite entries, are left out; a shorter vector counts as carried on with zero entries.
    Components that have no spread (all rows alike, fewer distinct rows than the width) have
    ``whitened`` null and ``explained`` 0. Keys may be null or repeat; each row has its own rows in the
    result. An empty table gives none. Columns of other names are never read.
    """
    if fit not in ("count", "one"):
        raise ValueError("fit is 'count' or 'one'")
    rows = table.where(is_whole(F.col(vector))).select(
        F.col(key).alias("id"), integer_entries(F.col(vector), scale, shift).alias("x")
    )
    distinct = distinct_vectors(rows).withColumn("once", F.lit(1).cast("long"))
    distinct = stage(distinct, "whitening-distinct")
    n_rows = distinct.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n")).first()["n"]
    width = widest(distinct, "x")[1]
    weight = "times" if fit == "count" else "once"
    model = fit_whitening(distinct, weight, width, shift)
    count = min(components, width)
    whitened = stage(whiten_distinct(distinct, model, count), "whitening-whitened")
    error = identity_error(whitened, weight, model.n, count)
    shares = np.where(np.isnan(model.scales), 0.0, model.values) / (model.trace or 1.0)
    explained = F.array(*[F.lit(float(share)) for share in shares[:count]]).cast("array<double>")
    at = F.col("at") + 1
    return (
        join_back(rows, whitened, n_rows)
        .select("id", "deviation", F.posexplode("whitened").alias("at", "value"))
        .select(
            "id",
            at.alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            F.when(~F.isnan("value"), F.col("value")).alias("whitened"),
            F.element_at(explained, at).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
