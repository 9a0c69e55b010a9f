"""A log of numbered versions for keyed tables: what each write changed.

``keep_changes`` starts the log of a table. From then on the writers of this package record every append,
overwrite and schema change as a commit: the change rows (``insert``, ``update_preimage``,
``update_postimage``, ``delete``) in a folder of their own, an entry under ``prepared`` once they are
written, then the table itself, then an entry under ``commits``. A write that stops between the two entries
is finished by the next one, from the written change rows; one that stops before the first leaves nothing
but a folder that nobody reads. A write that carries a ``txn`` name is done once, however often it is run.

Readers see committed versions only: ``read_changes`` a span of versions, ``read_version`` the table as of
a version, by undoing what came after it, and ``diff_versions`` the net changes between two. Tables have one
writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from passagemill.operators.changes import (
    DELETE,
    INSERT,
    UPDATE,
    UPDATE_BEFORE,
    diff_snapshots,
)
from passagemill.sources.tables import (
    CHANGE_FEED,
    get_property,
    has_change_feed,
    location,
    new_version_folder,
    point_at,
    set_change_feed,
    set_property,
    write_version,
)

LOG_PATH = f"{CHANGE_FEED}.path"
LOG_KEY = f"{CHANGE_FEED}.key"
ENTRY = (
    "version bigint, txn string, kind string, folder string, rows_folder string, old_folder string, "
    "change_count bigint"
)


@dataclass(frozen=True)
class ChangeLog:
    table: str
    path: str
    key: str

    def entries(self, spark: SparkSession, state: str) -> DataFrame:
        return spark.read.schema(ENTRY).parquet(f"{self.path}/{state}")

    def add_entry(self, spark: SparkSession, state: str, entry: tuple) -> None:
        row = spark.createDataFrame([entry], ENTRY).coalesce(1)
        row.write.mode("append").parquet(f"{self.path}/{state}")

    def change_schema(self, spark: SparkSession) -> StructType:
        """The table's columns and those of a change row. Older change rows lack later columns: null."""
        fields = StructType([*spark.table(self.table).schema.fields])
        return fields.add("_change_type", StringType()).add("_commit_version", LongType())

    def read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        schema = self.change_schema(spark)
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)


def keep_changes(spark: SparkSession, name: str, key: str, path: str | None = None) -> ChangeLog:
    """Start the log of an existing table; its rows now are version 0. A log that is there stays.

    ``path`` is a folder that all executors reach, below the table's own if not given.
    """
    held = change_log(spark, name)
    if held is not None:
        return held
    path = path or f"{location(spark, name).split('/_version-')[0]}/_change_log"
    log = ChangeLog(name, path, key)
    for state in ("prepared", "commits"):
        spark.createDataFrame([], ENTRY).write.parquet(f"{path}/{state}")
    set_property(spark, name, LOG_PATH, path)
    set_property(spark, name, LOG_KEY, key)
    set_change_feed(spark, name)
    return log


def change_log(spark: SparkSession, name: str) -> ChangeLog | None:
    """The log of a table, none if it has none or its change feed is off."""
    if not spark.catalog.tableExists(name) or not has_change_feed(spark, name):
        return None
    path, key = get_property(spark, name, LOG_PATH), get_property(spark, name, LOG_KEY)
    return None if path is None else ChangeLog(name, path, key)


def commits(spark: SparkSession, name: str) -> DataFrame:
    """``version, txn, kind, change_count`` of each committed write."""
    return _log(spark, name).entries(spark, "commits").select("version", "txn", "kind", "change_count")


def current_version(spark: SparkSession, name: str) -> int:
    return _last_version(spark, _log(spark, name))


def _log(spark: SparkSession, name: str) -> ChangeLog:
    log = change_log(spark, name)
    if log is None:
        raise ValueError(f"{name} has no change log")
    return log


def _last_version(spark: SparkSession, log: ChangeLog) -> int:
    return log.entries(spark, "commits").agg(F.max("version")).first()[0] or 0


# ---- writing


def finish_prepared(spark: SparkSession, log: ChangeLog) -> None:
    """Finish a write that stopped after its change rows were prepared."""
    done = log.entries(spark, "commits").select("version")
    for entry in log.entries(spark, "prepared").join(done, "version", "left_anti").collect():
        _finish(spark, log, entry.asDict())


def _finish(spark: SparkSession, log: ChangeLog, entry: dict) -> None:
    """The table's part of a write, then the entry that commits it. Running it twice does it once."""
    if entry["rows_folder"] is not None:
        point_at(spark, log.table, entry["rows_folder"])
    else:
        rows = log.read(spark, [entry["folder"]]).drop("_change_type", "_commit_version")
        held = spark.table(log.table).select(log.key)
        fresh = rows.join(held, log.key, "left_anti").select(*spark.table(log.table).columns)
        fresh.write.mode("append").format("parquet").saveAsTable(log.table)
    log.add_entry(spark, "commits", tuple(entry.values()))


def _commit(
    spark: SparkSession,
    log: ChangeLog,
    kind: str,
    txn: str,
    changes: DataFrame,
    version: int,
    rows_folder: str | None,
) -> None:
    folder = f"{log.path}/changes/{version:012d}-{uuid.uuid4().hex[:12]}"
    changes.write.parquet(folder)
    count = spark.read.schema(changes.schema).parquet(folder).count()
    old = location(spark, log.table)
    entry = {
        "version": version,
        "txn": txn,
        "kind": kind,
        "folder": folder,
        "rows_folder": rows_folder,
        "old_folder": old,
        "change_count": count,
    }
    log.add_entry(spark, "prepared", tuple(entry.values()))
    _finish(spark, log, entry)


def _start(spark: SparkSession, log: ChangeLog, txn: str | None) -> int | None:
    """The version of the write to come; none if a write of this name is committed."""
    finish_prepared(spark, log)
    entries = log.entries(spark, "commits")
    if txn is not None and not entries.where(F.col("txn") == txn).isEmpty():
        return None
    return _last_version(spark, log) + 1


def logged_append(df: DataFrame, log: ChangeLog, txn: str | None = None) -> None:
    """Append the rows whose key the table does not hold, one for each key, as inserts."""
    spark = df.sparkSession
    version = _start(spark, log, txn)
    if version is None:
        return
    table = spark.table(log.table)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in df.columns}
    rows = df.dropDuplicates([log.key]).join(table.select(log.key), log.key, "left_anti")
    changes = rows.withColumns(missing).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields],
        F.lit(INSERT).alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
    )
    _commit(spark, log, "append", txn or uuid.uuid4().hex, changes, version, None)


def logged_replace(df: DataFrame, log: ChangeLog, kind: str, txn: str | None = None) -> None:
    """Replace the rows by ``df``, which may add columns; what differs from the old rows is logged.

    The new rows are written once and compared as written; only rows that differ are logged whole.
    """
    spark = df.sparkSession
    version = _start(spark, log, txn)
    if version is None:
        return
    folder = new_version_folder(spark, log.table)
    write_version(df, log.table, folder)
    new = spark.read.parquet(folder)
    changes = diff_snapshots(spark.table(log.table), new, log.key, version, preimages=True)
    _commit(spark, log, kind, txn or uuid.uuid4().hex, changes, version, folder)


# ---- reading


def read_changes(
    spark: SparkSession, name: str, after: int = 0, upto: int | None = None
) -> DataFrame:
    """Change rows of the committed versions above ``after``, up to ``upto`` (the last if not given)."""
    log = _log(spark, name)
    oldest = int(get_property(spark, name, f"{CHANGE_FEED}.oldest") or 0)
    if after < oldest:
        raise ValueError(f"changes up to version {oldest} are no longer kept")
    wanted = F.col("version") > after
    if upto is not None:
        wanted &= F.col("version") <= upto
    entries = log.entries(spark, "commits").where(wanted).select("folder").distinct().collect()
    return log.read(spark, sorted(entry["folder"] for entry in entries))


def _ends(changes: DataFrame, key: str) -> DataFrame:
    """Per key ``_first``, its row before the changes, and ``_last``, its row after them, null where there
    is none. Aggregated in each task before the shuffle."""
    values = [c for c in changes.columns if c not in (key, "_change_type", "_commit_version")]
    kind, age = F.col("_change_type"), F.col("_commit_version")

    def end(pick, given: Column, there: Column) -> Column:
        row = F.when(given, F.struct(F.when(there, F.struct(*values)).alias("row")))
        return pick(row, F.when(given, age))["row"]

    before = end(F.min_by, kind != UPDATE, kind != INSERT)
    after = end(F.max_by, kind != UPDATE_BEFORE, kind != DELETE)
    return changes.groupBy(key).agg(before.alias("_first"), after.alias("_last"))


def read_version(spark: SparkSession, name: str, version: int) -> DataFrame:
    """The table as it was after a version: rows of keys that changed later are put back.

    Costs the changes since then and one pass over the table, which is only filtered by key. Columns that
    were added later are null in the rows put back.
    """
    log = _log(spark, name)
    table = spark.table(name)
    later = _ends(read_changes(spark, name, version), log.key)
    same = table.join(later.select(log.key), log.key, "left_anti")
    back = later.where(F.col("_first").isNotNull()).select(log.key, "_first.*")
    return same.select(*table.columns).unionByName(back.select(*table.columns))


def diff_versions(spark: SparkSession, name: str, old: int, new: int) -> DataFrame:
    """The net changes from one version to a later one, in the form of ``diff_snapshots``.

    A row that was changed and changed back, or added and deleted, does not appear.
    """
    log = _log(spark, name)
    ends = _ends(read_changes(spark, name, old, new), log.key)
    first, last = F.col("_first"), F.col("_last")
    kind = (
        F.when(first.isNull() & last.isNotNull(), INSERT)
        .when(first.isNotNull() & last.isNull(), DELETE)
        .when(first.isNotNull() & ~first.eqNullSafe(last), UPDATE)
    )
    return (
        ends.select(log.key, kind.alias("_change_type"), F.coalesce(last, first).alias("_row"))
        .where(F.col("_change_type").isNotNull())
        .select(log.key, "_row.*", "_change_type", F.lit(new).cast("bigint").alias("_commit_version"))
    )


def forget_versions(spark: SparkSession, name: str, upto: int) -> None:
    """Remove the change rows of versions up to ``upto`` and the table folders that those versions left.

    From then on ``read_version`` goes back to ``upto`` at most. Only folders that the log names are
    removed, never the table's own or one that a later version uses.
    """
    log = _log(spark, name)
    finish_prepared(spark, log)
    entries = [e.asDict() for e in log.entries(spark, "commits").collect()]
    used = {location(spark, name)} | {e["rows_folder"] for e in entries if e["version"] > upto}
    set_property(spark, name, f"{CHANGE_FEED}.oldest", str(upto))
    gone = {e["folder"] for e in entries if e["version"] <= upto}
    gone |= {e["old_folder"] for e in entries if e["version"] <= upto and "/_version-" in e["old_folder"]}
    names = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in sorted(gone - used):
        path = names.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
