"""Change rows of a keyed table: finding them and applying them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.session import stage

INSERT = "insert"
UPDATE = "update_postimage"
UPDATE_BEFORE = "update_preimage"
DELETE = "delete"


def diff_snapshots(
    old: DataFrame, new: DataFrame, key: str, version: int, preimages: bool = False
) -> DataFrame:
    """The rows to insert, update or delete to get from ``old`` to ``new``.

    A deleted row carries its old values. With ``preimages`` an updated row comes with its old values too. Keys are unique in both snapshots. A column that ``old``
    lacks counts as null there. Rows are compared by a 128-bit digest of their values, and only the
    rows that differ are fetched whole.
    """
    columns = [name for name in new.columns if name != key]
    types = {field.name: field.dataType for field in new.schema.fields}
    before = old.select(
        key,
        *[
            F.col(name) if name in old.columns else F.lit(None).cast(types[name]).alias(name)
            for name in columns
        ],
    )
    after = new.select(key, *columns)

    def marked(rows: DataFrame, name: str) -> DataFrame:
        digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
        return rows.select(key, digest.alias(name))

    kind = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(F.col("_old") != F.col("_new"), UPDATE)
    )
    changed = stage(
        marked(before, "_old")
        .join(marked(after, "_new"), key, "full_outer")
        .select(key, kind.alias("_change_type"))
        .where(F.col("_change_type").isNotNull()),
        "changed-keys",
    )
    gone = F.col("_change_type") == DELETE
    replaced = changed.where(gone)
    if preimages:
        updated = changed.where(F.col("_change_type") == UPDATE)
        replaced = replaced.union(updated.select(key, F.lit(UPDATE_BEFORE)))
    # written apart, so that Spark knows how few they are and need not shuffle the old rows for them
    replaced = stage(replaced, "replaced-keys")
    return (
        after.join(changed.where(~gone), key)
        .unionByName(before.join(replaced, key))
        .select(key, *columns, "_change_type", F.lit(version).cast("bigint").alias("_commit_version"))
    )


def versioned(rows: DataFrame, version: int) -> DataFrame:
    """Plain rows as the first state of a table that takes changes."""
    return rows.withColumn("_commit_version", F.lit(version).cast("bigint")).withColumn(
        "_deleted", F.lit(False)
    )


def live(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("_deleted")).drop("_deleted")


def latest_changes(changes: DataFrame, key: str) -> DataFrame:
    """Per key the change of the highest version, in the form of table rows.

    Within one version an insert or update wins over a delete. Aggregated per task before the
    shuffle, so a key with very many changes costs one row per task.
    """
    values = [name for name in changes.columns if name not in (key, "_change_type")]
    rows = changes.where(F.col("_change_type") != UPDATE_BEFORE).select(
        key, F.struct(*values, (F.col("_change_type") == DELETE).alias("_deleted")).alias("_row")
    )
    age = F.struct(
        F.col("_row._commit_version"), ~F.col("_row._deleted"), F.xxhash64(F.col("_row"))
    )
    return rows.groupBy(key).agg(F.max_by("_row", age).alias("_row")).select(key, "_row.*")


def latest_rows(rows: DataFrame, key: str) -> DataFrame:
    """Per key the row of the highest version; within one, a row that is there wins over a
    tombstone."""
    values = [name for name in rows.columns if name != key]
    packed = rows.select(key, F.struct(*values).alias("_row"))
    age = F.struct(
        F.col("_row._commit_version"), ~F.col("_row._deleted"), F.xxhash64(F.col("_row"))
    )
    return packed.groupBy(key).agg(F.max_by("_row", age).alias("_row")).select(key, "_row.*")


def apply_changes(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after the changes. Deleted keys stay as tombstones with their version, so that a
    change of a lower version that arrives late loses; ``live`` hides them."""
    columns = [name for name in base.columns if name != key]
    stored = base.select(key, F.struct(*columns).alias("_stored"))
    coming = latest_changes(changes, key).select(key, F.struct(*columns).alias("_coming"))
    newer = F.col("_stored").isNull() | (
        F.col("_coming._commit_version") >= F.col("_stored._commit_version")
    )
    row = F.when(F.col("_coming").isNotNull() & newer, F.col("_coming")).otherwise(F.col("_stored"))
    return (
        stored.join(coming, key, "full_outer")
        .withColumn("_row", row)
        .select(key, *[F.col(f"_row.{name}").alias(name) for name in columns])
        .select(*base.columns)
    )
