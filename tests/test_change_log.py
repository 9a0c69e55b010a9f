import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from passagemill.operators.index import build_index, open_index
from passagemill.sources import change_log, tables
from passagemill.sources.change_log import (
    commits,
    current_version,
    diff_versions,
    forget_versions,
    keep_changes,
    read_changes,
    read_version,
)
from passagemill.sources.writers import (
    set_change_feed,
    write_append,
    write_evolved,
    write_overwrite,
)
from passagemill.streaming.sync import replace_table, sync_index_log

SCHEMA = "id long, v string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def state(df):
    return ordered(tuple(row) for row in df.collect())


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, value) for value in row])


def changes(spark, name, **span):
    rows = read_changes(spark, name, **span).select("id", "v", "_change_type", "_commit_version")
    return ordered(tuple(row) for row in rows.collect())


@pytest.fixture
def table(spark, folder):
    name = f"logged_{uuid.uuid4().hex}"
    write_overwrite(frame(spark, [(1, "a"), (2, "b")]), name, f"{folder}/table")
    keep_changes(spark, name, "id")
    return name


def test_every_kind_of_write_is_logged(spark, table):
    write_append(frame(spark, [(3, "c"), (3, "c"), (1, "other")]), table)
    write_overwrite(frame(spark, [(1, "a"), (2, "B"), (4, "d")]), table)
    wide = spark.table(table).where("id > 1").withColumn("n", F.length("v"))
    write_evolved(wide, table)
    assert changes(spark, table, upto=1) == [(3, "c", "insert", 1)]
    assert changes(spark, table, after=1, upto=2) == [
        (2, "B", "update_postimage", 2),
        (2, "b", "update_preimage", 2),
        (3, "c", "delete", 2),
        (4, "d", "insert", 2),
    ]
    last = read_changes(spark, table, after=2)
    assert state(last.select("id", "v", "n", "_change_type")) == [
        (1, "a", None, "delete"),
        (2, "B", 1, "update_postimage"),
        (2, "B", None, "update_preimage"),
        (4, "d", 1, "update_postimage"),
        (4, "d", None, "update_preimage"),
    ]
    assert state(commits(spark, table).select("version", "kind", "change_count")) == [
        (1, "append", 1),
        (2, "overwrite", 4),
        (3, "evolve", 5),
    ]
    assert state(spark.table(table)) == [(2, "B", 1), (4, "d", 1)]


def test_versions_and_their_differences(spark, table):
    states = {0: [(1, "a"), (2, "b")]}
    steps = [
        (write_append, [(3, "c")]),
        (write_overwrite, [(2, "x"), (3, "c"), (5, "e")]),
        (write_append, [(1, "back")]),
        (write_overwrite, [(1, "a"), (2, "b"), (3, "c")]),
        (write_overwrite, []),
    ]
    for version, (write, rows) in enumerate(steps, 1):
        write(frame(spark, rows), table)
        states[version] = state(spark.table(table))
    assert states[3] == [(1, "back"), (2, "x"), (3, "c"), (5, "e")]
    assert current_version(spark, table) == 5
    for version, rows in states.items():
        assert state(read_version(spark, table, version)) == rows
    for old, new in ((0, 1), (0, 4), (1, 3), (2, 4), (3, 5)):
        before, after = dict(states[old]), dict(states[new])
        want = [
            (i, v, "insert" if i not in before else "update_postimage", new)
            for i, v in after.items()
            if before.get(i) != v
        ]
        want += [(i, v, "delete", new) for i, v in before.items() if i not in after]
        found = diff_versions(spark, table, old, new)
        assert state(found.select("id", "v", "_change_type", "_commit_version")) == sorted(want)


def test_a_named_write_is_done_once(spark, table):
    for _ in range(2):
        write_append(frame(spark, [(3, "c")]), table, txn="load-1")
    write_overwrite(frame(spark, [(9, "z")]), table, txn="load-2")
    write_append(frame(spark, [(7, "g")]), table, txn="load-1")
    write_overwrite(frame(spark, [(8, "y")]), table, txn="load-2")
    assert state(spark.table(table)) == [(9, "z")] and current_version(spark, table) == 2


@pytest.mark.parametrize("point", ["changes", "prepared", "table", "committed"])
@pytest.mark.parametrize("write", [write_append, write_overwrite])
def test_a_write_that_stops_is_finished_or_left_out(spark, table, point, write, monkeypatch):
    class Crash(Exception):
        pass

    def crash(*_, **__):
        raise Crash

    true_entry = change_log.ChangeLog.add_entry

    def entry(self, session, kind, row):
        if kind == {"changes": "prepared", "table": "commits"}.get(point):
            raise Crash
        true_entry(self, session, kind, row)
        if point == "committed" and kind == "commits":
            raise Crash

    rows = frame(spark, [(1, "a"), (3, "c")])
    with monkeypatch.context() as patched:
        patched.setattr(change_log.ChangeLog, "add_entry", entry)
        if point == "prepared":
            patched.setattr(change_log, "_finish", crash)
        with pytest.raises(Crash):
            write(rows, table, txn="it")
    if point in ("changes", "prepared"):
        assert state(spark.table(table)) == [(1, "a"), (2, "b")]
    whole = [(1, "a"), (3, "c")] if write is write_overwrite else [(1, "a"), (2, "b"), (3, "c")]
    first = 1
    if point == "prepared":
        # the next write, whatever it is, finishes this one first
        write_append(frame(spark, [(3, "never")]), table)
        first = 2
    write(rows, table, txn="it")
    assert state(spark.table(table)) == whole
    assert current_version(spark, table) == first
    want = [(3, "c", "insert", 1)] + ([(2, "b", "delete", 1)] if write is write_overwrite else [])
    assert changes(spark, table) == sorted(want)


def test_old_versions_are_forgotten(spark, table, folder):
    for number in range(3):
        write_overwrite(frame(spark, [(1, f"v{number}"), (2, "b")]), table)
    held = tables.location(spark, table)
    forget_versions(spark, table, 2)
    assert tables.location(spark, table) == held
    assert state(spark.table(table)) == [(1, "v2"), (2, "b")]
    assert state(read_version(spark, table, 2)) == [(1, "v1"), (2, "b")]
    for late in (lambda: read_version(spark, table, 1), lambda: read_changes(spark, table)):
        with pytest.raises(ValueError):
            late()
    root = Path(held.replace("file:", "")).parent
    # the present folder, and the one before it, which readers may still use
    assert len(list(root.glob("_version-*"))) == 2
    assert len(list((root / "_change_log" / "changes").iterdir())) == 1
    write_append(frame(spark, [(5, "e")]), table)
    assert current_version(spark, table) == 4


def test_switch_and_edges(spark, table, folder):
    set_change_feed(spark, table, False)
    write_append(frame(spark, [(6, "f")]), table)
    set_change_feed(spark, table, True)
    assert changes(spark, table) == [] and state(spark.table(table))[-1] == (6, "f")
    write_append(frame(spark, []), table)
    write_append(frame(spark, [(7,)], "id long"), table)  # a column that the rows lack is null
    assert changes(spark, table) == [(7, None, "insert", 2)]
    with pytest.raises(ValueError):
        write_append(frame(spark, [(8, "h")]), table, key="v")
    with pytest.raises(ValueError):
        read_changes(spark, "none_such")
    assert keep_changes(spark, table, "id").path == change_log.change_log(spark, table).path
    replace_table(frame(spark, [(7, "g")]), table, "id", 99, f"{folder}/feed")
    assert current_version(spark, table) == 3  # the log numbers versions itself


def test_appends_reach_the_index(spark, folder):
    def rows(*keys, word="t"):
        return frame(
            spark,
            [(key, f"{word}{key}", [float(key), 1.0]) for key in keys],
            "id long, content string, embedding array<float>",
        )

    name, path, checkpoint = "logged_chunks", f"{folder}/index", f"{folder}/checkpoint"
    write_overwrite(rows(1, 2, 3), name, f"{folder}/table")
    keep_changes(spark, name, "id")
    build_index(spark.table(name), path, dim=2, cells=2)

    def indexed():
        sync_index_log(spark, name, path, checkpoint)
        return sorted(r["content"] for r in open_index(spark, path).rows(spark).collect())

    assert indexed() == ["t1", "t2", "t3"]
    write_append(rows(3, 4, 5, word="u"), name)
    assert indexed() == ["t1", "t2", "t3", "u4", "u5"]
    write_append(rows(6), name)
    write_overwrite(rows(1, 6, word="w"), name)
    assert indexed() == ["w1", "w6"] and indexed() == ["w1", "w6"]
    index = open_index(spark, path)
    assert sum(load.rows - load.dead for load in index.loads(spark)) == 2
