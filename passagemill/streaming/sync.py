"""Triggered sync of a vector index from the change rows of its table."""

from __future__ import annotations

import uuid
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.functions.vectors import vector_fault
from passagemill.operators.changes import (
    DELETE,
    UPDATE_BEFORE,
    diff_snapshots,
)
from passagemill.operators.index import (
    MOST_DEAD,
    VectorIndex,
    add_changes,
    build_index,
    compact_index,
    forget_replaced,
    index_exists,
    merge_loads,
    nearest_cell,
    open_index,
    write_rejected,
)
from passagemill.sources.change_log import ENTRY, change_log
from passagemill.sources.writers import has_change_feed, write_evolved

#: More loads than this are merged after a sync, and more dead rows than this share are removed.
MOST_LOADS = 8
MOST_DEAD_SHARE = 0.2


def append_changes(changes: DataFrame, path: str) -> None:
    """Add change rows to the feed that the sync reads."""
    changes.write.mode("append").parquet(path)


def apply_to_index(
    spark: SparkSession, index: VectorIndex, changes: DataFrame, load: str | None = None
) -> None:
    """Add change rows to the index as a load of their own; no stored row is rewritten.

    A row whose new vector cannot be indexed leaves the index and is listed in ``rejected``. A load
    with a name that the index has already is not added again, so a batch may be replayed after a
    failure at any point: before its entry is written, none of its rows count.
    """
    load = load or uuid.uuid4().hex[:12]
    if changes.isEmpty() or index.has_load(spark, load):
        return
    fault = F.when(
        ~F.col("_change_type").isin(DELETE, UPDATE_BEFORE),
        vector_fault(F.col(index.vector), index.dim),
    )
    checked = changes.withColumn("fault", fault)
    write_rejected(checked.where(F.col("fault").isNotNull()), index.path, load)
    kind = F.when(F.col("fault").isNotNull(), DELETE).otherwise(F.col("_change_type"))
    placed = (
        checked.withColumn("_change_type", kind)
        .drop("fault")
        .withColumn("cell", nearest_cell(F.col(index.vector), index.centroids))
    )
    add_changes(spark, index, placed, load)


def sync_index_stream(
    spark: SparkSession,
    feed: str,
    feed_schema,
    index_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Apply the change rows that arrived since the last call, then stop.

    ``files_per_batch`` cuts a long backlog into several batches; versions make their order
    irrelevant.
    """
    index = open_index(spark, index_path)
    reader = spark.readStream.schema(feed_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    source = md5(checkpoint.encode()).hexdigest()[:8]
    query = (
        reader.parquet(feed)
        .writeStream.foreachBatch(
            lambda batch, number: apply_to_index(spark, index, batch, f"{source}-{number}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def replace_table(df: DataFrame, name: str, key: str, version: int, feed: str) -> None:
    """Replace a keyed table; while its change feed is on, the differences go to the feed first.

    Running it again after a failure adds the same change rows again, which a sync takes as one. A table
    with a change log numbers its versions and keeps its changes itself.
    """
    spark = df.sparkSession
    held = spark.catalog.tableExists(name) and has_change_feed(spark, name)
    if held and change_log(spark, name) is None:
        append_changes(diff_snapshots(spark.table(name), df, key, version), feed)
    write_evolved(df, name)


def sync_index_log(spark: SparkSession, name: str, index_path: str, checkpoint: str) -> None:
    """Apply the versions that were committed to a table since the last call, then stop.

    The stream is that of the log's entries, so change rows of a write that is not committed are never
    seen. A batch is one load of the index, named by its number, and adds nothing when it is run again.
    """
    log = change_log(spark, name)
    index = open_index(spark, index_path)
    source = md5(checkpoint.encode()).hexdigest()[:8]

    def apply(batch: DataFrame, number: int) -> None:
        # one short entry for each write
        folders = sorted({entry["folder"] for entry in batch.select("folder").collect()})
        if folders:
            changes = log.read(batch.sparkSession, folders)
            apply_to_index(batch.sparkSession, index, changes, f"{source}-{number}")

    query = (
        spark.readStream.schema(ENTRY)
        .parquet(f"{log.path}/commits")
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    tidy_loads(spark, open_index(spark, index_path))


def create_or_sync(
    spark: SparkSession,
    table: DataFrame,
    feed: str,
    feed_schema,
    index_path: str,
    checkpoint: str,
    **build,
) -> VectorIndex:
    """Build the index from the table if there is none yet, else take on the waiting changes."""
    if not index_exists(spark, index_path):
        return build_index(table, index_path, **build)
    sync_index_stream(spark, feed, feed_schema, index_path, checkpoint)
    index = open_index(spark, index_path)
    tidy_loads(spark, index)
    return index


def tidy_loads(spark: SparkSession, index: VectorIndex) -> None:
    """Keep loads and dead rows few.

    From ``MOST_LOADS`` on all loads but the first are merged, so the cost is that of the changes and
    not of the index. Once the dead rows are many, or a fair share of all, everything becomes one load.
    What earlier calls have merged is deleted first, so stored rows are those of the index and of the
    loads of one merge. Who opened the index since the last call can go on reading it.
    """
    forget_replaced(spark, index.path)
    loads = index.loads(spark)
    dead, rows = sum(load.dead for load in loads), sum(load.rows for load in loads)
    if len(loads) > 1 and dead > min(MOST_DEAD, MOST_DEAD_SHARE * rows):
        compact_index(spark, index.path)
    elif len(loads) > MOST_LOADS:
        merge_loads(spark, index.path, loads[1:])
