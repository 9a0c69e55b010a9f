"""Sharding by rendezvous hashing.

Every shard draws a number for a record from the record's key, the shard's name and the shard's
weight, and the highest draw wins. A new shard can only win records, never move them between the old
ones, and a share of weight is a share of records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from passagemill.session import stage

#: Draws use this many bits of the hash, which a double holds exactly.
BITS = 52


def winning_shard(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that wins ``key``; shards without weight never win.

    A draw is ``-weight / ln(u)`` with ``u`` uniform in (0, 1) from the hash of key and shard. A null
    key is a key like any other. Equal draws go to the higher shard number.
    """
    if not any(weight > 0 for weight in weights):
        raise ValueError("at least one shard needs a weight above zero")

    def draw(shard: int, weight: float) -> Column:
        high = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 64 - BITS)
        return F.lit(-float(weight)) / F.log((high + F.lit(0.5)) / F.lit(float(1 << BITS)))

    draws = [
        F.struct(draw(shard, weight).alias("draw"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["shard"]


def assign_shards(
    rows: DataFrame,
    key: Column,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``shard``, and ``grown_shard`` under the second weights if they are given.

    Columns with these names are replaced. Rows with one key go to one shard, so repeated rows stay
    together; an empty table gives an empty table.
    """
    out = rows.withColumn("shard", winning_shard(key, weights))
    return out if grown is None else out.withColumn("grown_shard", winning_shard(key, grown))


def number_slots(rows: DataFrame, label: str = "slots") -> DataFrame:
    """Add ``slot``: the row's place in its ``shard``, gapless from 0.

    Each task numbers its own rows per shard while they are written; the sums of the tasks before it
    are then added. No shard's rows ever meet in one task, however many one key has.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(0, dtype=np.int64)
        for batch in batches:
            shards = batch.column("shard").to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(shards):
                continue
            if shards.max() >= len(seen):
                seen = np.concatenate([seen, np.zeros(shards.max() + 1 - len(seen), np.int64)])
            order = np.argsort(shards, kind="stable")
            ordered = shards[order]
            first = np.searchsorted(ordered, ordered)
            places = np.empty(len(shards), dtype=np.int64)
            places[order] = np.arange(len(shards)) - first + seen[ordered]
            seen += np.bincount(shards, minlength=len(seen))
            columns = [*batch.columns, pa.array(places), pa.array(np.full(len(shards), part))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "slot", "slot_part"])

    rows = rows.drop("slot", "slot_part")
    added = T.StructType().add("slot", "long").add("slot_part", "long")
    schema = T.StructType([*rows.schema.fields, *added.fields])
    placed = stage(rows.mapInArrow(numbered, schema), label)
    totals = placed.groupBy("shard", "slot_part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("slot_part")
    starts = totals.select(
        "shard",
        "slot_part",
        (F.sum("rows").over(before) - F.col("rows")).alias("slot_start"),
    )
    return (
        placed.join(starts, ["shard", "slot_part"])
        .withColumn("slot", F.col("slot") + F.col("slot_start"))
        .drop("slot_part", "slot_start")
    )


def write_shards(rows: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write one folder per shard, each in so many files."""
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files_per_shard))
    shards = rows.withColumn("file", deal)
    shards.repartition("shard", "file").drop("file").write.partitionBy("shard").parquet(path)
