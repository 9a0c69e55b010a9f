from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from passagemill.operators.changes import (
    DELETE,
    INSERT,
    UPDATE,
    UPDATE_BEFORE,
    apply_changes,
    diff_snapshots,
    live,
    versioned,
)

ROWS = "id bigint, content string"
CHANGES = "id bigint, content string, _change_type string, _commit_version bigint"


def state(df):
    return {r["id"]: r["content"] for r in live(df).collect()}


def test_changes_of_all_kinds(spark):
    base = versioned(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], ROWS), 5)
    changes = [
        (2, "b", UPDATE_BEFORE, 6),
        (2, "B", UPDATE, 6),
        (3, "c", DELETE, 6),
        (9, "?", DELETE, 6),
        (5, "e1", INSERT, 6),
        (5, "e2", UPDATE, 7),
        (4, "late", UPDATE, 4),
        (6, "x", DELETE, 6),
        (6, "again", INSERT, 6),
    ]
    after = apply_changes(base, spark.createDataFrame(changes, CHANGES), "id")
    assert state(after) == {1: "a", 2: "B", 4: "d", 5: "e2", 6: "again"}
    stored = {r["id"]: (r["_commit_version"], r["_deleted"]) for r in after.collect()}
    assert stored[3] == (6, True) and stored[9] == (6, True) and stored[4] == (5, False)
    # A change that arrives late, older than the tombstone, must not bring the row back.
    late = spark.createDataFrame([(3, "old", UPDATE, 5), (9, "old", INSERT, 3)], CHANGES)
    assert state(apply_changes(after, late, "id")) == state(after)


def test_replay_changes_nothing(spark):
    base = versioned(spark.createDataFrame([(1, "a"), (2, "b")], ROWS), 0)
    changes = spark.createDataFrame([(1, "A", UPDATE, 1), (2, "b", DELETE, 1)], CHANGES)
    once = apply_changes(base, changes, "id")
    twice = apply_changes(once, changes, "id")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_one_key_with_most_changes(spark):
    base = versioned(spark.createDataFrame([(1, "a")], ROWS), 0)
    changes = spark.range(1, 20_001).selectExpr(
        "if(id % 3 > 0, 7, id) as id",
        "cast(id as string) as content",
        f"'{UPDATE}' as _change_type",
        "id as _commit_version",
    )
    after = state(apply_changes(base, changes, "id"))
    assert after[7] == "20000" and len(after) == 2 + 20_000 // 3


content = st.one_of(st.none(), st.sampled_from(["", "x", "y"]))
snapshot = st.dictionaries(st.integers(0, 12), content, max_size=10)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=snapshot, second=snapshot, third=snapshot)
def test_diff_then_apply(spark, first, second, third):
    old, mid, new = (spark.createDataFrame(list(s.items()), ROWS) for s in (first, second, third))
    changes = diff_snapshots(old, mid, "id", 1)
    kinds = {r["id"]: r["_change_type"] for r in changes.collect()}
    assert kinds == {
        key: INSERT if key not in first else DELETE if key not in second else UPDATE
        for key in first.keys() | second.keys()
        if key not in first or key not in second or first[key] != second[key]
    }
    both = changes.unionByName(diff_snapshots(mid, new, "id", 2))
    step = apply_changes(versioned(old, 0), changes, "id")
    assert state(step) == second
    assert state(apply_changes(step, diff_snapshots(mid, new, "id", 2), "id")) == third
    assert state(apply_changes(versioned(old, 0), both, "id")) == third


def test_few_deleted_rows_are_fetched_without_a_shuffle_of_the_old_table(spark):
    from pyspark.sql import functions as F

    old = spark.range(20_000).select("id", F.concat(F.lit("a"), "id").alias("t"))
    new = old.where("id >= 3").select("id", F.concat("t", F.lit("b")).alias("t"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "20000")
    try:
        changes = diff_snapshots(old, new, "id", 1)
        plan = changes._jdf.queryExecution().sparkPlan().toString()
        found = {row["_change_type"]: row["count"] for row in changes.groupBy("_change_type").count().collect()}
    finally:
        spark.conf.set(setting, before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert found == {"delete": 3, "update_postimage": 19_997}
