import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from passagemill.operators.changes import diff_snapshots
from passagemill.operators.index import (
    build_index,
    compact_index,
    describe_index,
    index_exists,
    open_index,
    probes_for_recall,
    rows_per_cell,
)
from passagemill.operators.keys import add_content_key, add_dense_id
from passagemill.sources.writers import has_change_feed, set_change_feed, write_overwrite
from passagemill.streaming.sync import (
    append_changes,
    apply_to_index,
    create_or_sync,
    replace_table,
)

BUILD = dict(dim=4, cells=3, embedder="test")


def table(spark, n, text="t"):
    angle = F.col("id") * 0.37
    return spark.range(n).select(
        "id",
        F.concat(F.lit(text), F.col("id")).alias("content"),
        F.array(F.sin(angle), F.cos(angle), F.sin(2 * angle), F.lit(1.0))
        .cast("array<float>")
        .alias("embedding"),
    )


def contents(spark, path):
    return {r["id"]: r["content"] for r in open_index(spark, path).rows(spark).collect()}


def test_missing_index(spark, folder):
    assert not index_exists(spark, folder + "/none")
    spark.range(1).write.parquet(folder + "/broken/meta")
    with pytest.raises(Exception) as failure:
        index_exists(spark, folder + "/broken")
    assert "PATH_NOT_FOUND" not in str(failure.value)


def test_other_failures_are_raised(spark, folder, monkeypatch):
    def denied(*_):
        raise AnalysisException("denied", errorClass="INSUFFICIENT_PERMISSIONS", messageParameters={})

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.parquet", denied)
    with pytest.raises(AnalysisException):
        index_exists(spark, folder)


def test_build_puts_every_row_in_one_cell(spark, folder):
    rows = table(spark, 90).unionByName(
        spark.createDataFrame([(900, "bad", [1.0])], "id long, content string, embedding array<float>")
    )
    index = build_index(rows, folder, **BUILD)
    assert index_exists(spark, folder)
    cells = index.rows(spark).groupBy("id").agg(F.count("*").alias("n"), F.max("cell").alias("c"))
    found = cells.collect()
    assert len(found) == 90 and all(r["n"] == 1 and 0 <= r["c"] < 3 for r in found)
    assert sum(r["row_count"] for r in rows_per_cell(spark, folder).collect()) == 90
    assert [r["fault"] for r in spark.read.parquet(folder + "/rejected").collect()] == ["width"]
    stats = describe_index(spark, folder).first()
    assert (stats["row_count"], stats["key_count"], stats["width"]) == (90, 90, 4)
    queries = index.rows(spark).select(F.col("id").alias("query_id"), "embedding")
    assert probes_for_recall(queries, index, 3, 1.0) <= 3


def test_sync_runs_only_when_called(spark, folder):
    path, feed, checkpoint = (f"{folder}/{n}" for n in ("index", "feed", "checkpoint"))
    first, second = table(spark, 40), table(spark, 60, "u").where("id >= 10")
    changes = diff_snapshots(first, second, "id", 1)

    def run():
        create_or_sync(spark, first, feed, changes.schema, path, checkpoint, **BUILD)
        return contents(spark, path)

    assert run() == {i: f"t{i}" for i in range(40)}
    append_changes(changes, feed)
    assert contents(spark, path) == {i: f"t{i}" for i in range(40)}
    expected = {i: f"u{i}" for i in range(10, 60)}
    assert run() == expected
    assert run() == expected  # nothing new
    late = changes.where("id = 3").withColumn("_change_type", F.lit("insert")).withColumn(
        "_commit_version", F.lit(0).cast("bigint")
    )
    append_changes(late, feed)
    assert run() == expected  # older than the tombstone
    stats = describe_index(spark, path).first()
    assert (stats["tombstone_count"], stats["last_version"]) == (10, 1)
    # A batch replayed after a failure leads to the same rows.
    apply_to_index(spark, open_index(spark, path), changes)
    assert contents(spark, path) == expected


def test_unusable_vectors_leave_the_index(spark, folder):
    index = build_index(table(spark, 20), folder, **BUILD)
    bad = [(3, "x", [1.0], "update_postimage", 1), (4, "t4", None, "delete", 1), (30, "y", None, "insert", 1)]
    schema = (
        "id bigint, content string, embedding array<float>, _change_type string, "
        "_commit_version bigint"
    )
    apply_to_index(spark, index, spark.createDataFrame(bad, schema), "sync")
    assert set(contents(spark, folder)) == set(range(20)) - {3, 4}
    rejected = spark.read.parquet(folder + "/rejected")
    assert {(r["id"], r["fault"]) for r in rejected.where("load = 'sync'").collect()} == {
        (3, "width"),
        (30, "null"),
    }


def test_replaced_table_feeds_its_changes(spark, folder):
    write_overwrite(table(spark, 5), "feeding")
    replace_table(table(spark, 6), "feeding", "id", 1, folder + "/feed")
    assert not index_exists(spark, folder + "/feed")
    set_change_feed(spark, "feeding")
    replace_table(table(spark, 7).where("id > 0"), "feeding", "id", 2, folder + "/feed")
    feed = {(r["id"], r["_change_type"]) for r in spark.read.parquet(folder + "/feed").collect()}
    assert feed == {(6, "insert"), (0, "delete")}
    assert has_change_feed(spark, "feeding") and spark.table("feeding").count() == 6


def _files(spark, index):
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{index.path}/rows/{index.build}")
    return {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}


def test_sync_adds_and_never_rewrites(spark, folder):
    index = build_index(table(spark, 80), folder, **BUILD)
    before = _files(spark, index)
    apply_to_index(spark, index, diff_snapshots(table(spark, 80), table(spark, 81), "id", 1))
    assert before < _files(spark, index)
    added = spark.read.parquet(*(_files(spark, index) - before))
    assert added.count() == 1 and len(contents(spark, folder)) == 81


def test_failure_before_the_entry_loses_no_row(spark, folder, monkeypatch):
    index = build_index(table(spark, 40), folder, **BUILD)
    old = contents(spark, folder)
    changes = diff_snapshots(table(spark, 40), table(spark, 50, "u"), "id", 1)

    class Crash(Exception):
        pass

    def crash(*_, **__):
        raise Crash

    with monkeypatch.context() as patched:
        # the entry of a load is the one table that is made from rows of the driver
        patched.setattr(type(spark), "createDataFrame", crash)
        with pytest.raises(Crash):
            apply_to_index(spark, index, changes, "batch")
    assert contents(spark, folder) == old
    apply_to_index(spark, index, changes, "batch")
    assert contents(spark, folder) == {i: f"u{i}" for i in range(50)}
    apply_to_index(spark, index, changes, "batch")
    assert len(index.loads(spark)) == 2


def test_compaction_keeps_rows_and_tombstones(spark, folder):
    index = build_index(table(spark, 30), folder, **BUILD)
    for version in range(1, 4):
        old, new = (table(spark, 30, f"v{n}").where(f"id >= {n}") for n in (version - 1, version))
        apply_to_index(spark, index, diff_snapshots(old, new, "id", version))
    held, stats = contents(spark, folder), describe_index(spark, folder).first()
    assert len(index.loads(spark)) == 4 and stats["tombstone_count"] == 3
    compact_index(spark, folder)
    assert len(index.loads(spark)) == 1
    assert contents(spark, folder) == held and describe_index(spark, folder).first() == stats


def test_added_column_while_the_feed_is_on(spark, folder):
    write_overwrite(table(spark, 5), "widening")
    set_change_feed(spark, "widening")
    wide = table(spark, 6).where("id > 0").withColumn("size", F.length("content"))
    replace_table(wide, "widening", "id", 1, folder + "/feed")
    feed = {
        (r["id"], r["_change_type"], r["size"]) for r in spark.read.parquet(folder + "/feed").collect()
    }
    assert feed == {(0, "delete", None), (5, "insert", 2)} | {
        (i, "update_postimage", 2) for i in range(1, 5)
    }
    assert has_change_feed(spark, "widening")
    assert {(r["id"], r["size"]) for r in spark.table("widening").collect()} == {(i, 2) for i in range(1, 6)}
    # narrower rows leave the column in place, empty
    replace_table(table(spark, 2), "widening", "id", 2, folder + "/feed")
    assert {(r["id"], r["size"]) for r in spark.table("widening").collect()} == {(0, None), (1, None)}


def test_content_key_depends_on_content_only(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, "a", None)]
    df = spark.createDataFrame(rows, "n int, x string, y string")
    keys = {r["n"]: r["id"] for r in add_content_key(df, ["x", "y"]).collect()}
    assert keys[1] == keys[3] != keys[2]


def test_dense_ids_with_a_hot_value(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    rows = add_dense_id(df.repartition(7), ["k"]).collect()
    assert sorted(r["id"] for r in rows) == list(range(3000))
    ordered = [r["k"] for r in sorted(rows, key=lambda r: r["id"])]
    assert ordered == sorted(ordered)


def test_changes_that_come_several_times_late_or_without_a_key(spark, folder):
    index = build_index(table(spark, 8), folder, version=5, **BUILD)
    says = [
        (1, "first", "update_postimage", 6), (1, "second", "update_postimage", 7),
        (2, "gone", "delete", 6), (2, "back", "insert", 6),
        (3, "late", "update_postimage", 4),
        (4, "twice", "update_postimage", 6), (4, "twice", "update_postimage", 6),
        (5, "once", "update_postimage", 6), (5, "before", "update_preimage", 6),
        (6, "late", "update_postimage", 3), (6, "later", "update_postimage", 4),
        (7, "gone", "delete", 6),
        (9, "new", "insert", 6),
        (None, "a", "insert", 6), (None, "b", "insert", 7),
    ]
    rows = spark.createDataFrame(says, "id long, content string, _change_type string, _commit_version long")
    vector = F.array(*[F.lit(x) for x in (1.0, 0.5, 0.2, 0.1)]).cast("array<float>")
    apply_to_index(spark, index, rows.withColumn("embedding", vector), "load")
    index = open_index(spark, folder)
    found = index.rows(spark).select("id", "content", "cell")
    assert {row["id"]: row["content"] for row in found.collect()} == {
        0: "t0", 1: "second", 2: "back", 3: "t3", 4: "twice", 5: "once", 6: "t6", 9: "new", None: "b",
    }
    assert found.count() == 9
    live = index.key_states(spark).where("not _deleted").select("id", "cell")
    assert sorted(map(str, live.collect())) == sorted(map(str, found.select("id", "cell").collect()))
    assert {row["id"] for row in index.key_states(spark).where("_deleted").collect()} == {7}
    total = rows_per_cell(spark, folder).agg(F.sum("row_count")).first()[0]
    assert total == 9


def test_a_sync_leaves_no_copies_behind(spark, folder):
    from pathlib import Path

    from passagemill.session import work_folder

    def copies():
        return {one.name for one in Path(work_folder(spark)).glob("index-*")}

    before = copies()
    states = [table(spark, 40, text) for text in "abc"]
    feed, path, checkpoint = (f"{folder}/{name}" for name in ("feed", "index", "checkpoint"))
    create_or_sync(spark, states[0], feed, None, path, checkpoint, key="id", **BUILD)
    for at, (old, new) in enumerate(zip(states, states[1:]), 1):
        changes = diff_snapshots(old, new, "id", at)
        append_changes(changes, feed)
        opened = open_index(spark, path).rows(spark)
        create_or_sync(spark, states[0], feed, changes.schema, path, checkpoint, key="id", **BUILD)
        # rows that were asked for before the call can still be read
        assert opened.count() == 40
    assert contents(spark, path) == {n: f"c{n}" for n in range(40)}
    assert copies() == before
    # the last merge, and the two loads that it replaced
    assert len(list(Path(path).glob("rows/*/_load=*"))) == 3
