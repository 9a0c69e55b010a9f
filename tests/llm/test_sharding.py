from collections import Counter

from pyspark.sql import functions as F

from passagemill.llm.sharding import assign_shards, number_slots, write_shards


def test_growth_moves_records_into_the_new_shard_only(spark):
    rows = spark.range(20_000)
    found = assign_shards(rows, F.col("id"), [1.0] * 8, [1.0] * 9).collect()
    assert all(row["grown_shard"] in (row["shard"], 8) for row in found)
    moved = sum(row["grown_shard"] == 8 for row in found)
    assert abs(moved / 20_000 - 1 / 9) < 0.01


def test_weights_are_shares(spark):
    counts = Counter(row["shard"] for row in assign_shards(spark.range(40_000), F.col("id"), [1.0, 2.0, 0.0, 5.0]).collect())
    assert counts[2] == 0
    assert abs(counts[3] / 40_000 - 5 / 8) < 0.015 and abs(counts[0] / 40_000 - 1 / 8) < 0.01


def test_slots_are_gapless_with_a_hot_key(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    found = number_slots(assign_shards(rows.repartition(7), F.col("id"), [1.0] * 4)).collect()
    for shard in range(4):
        slots = sorted(row["slot"] for row in found if row["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({row["shard"] for row in found if row["id"] == 7}) == 1


def test_edges(edge_docs, no_docs, folder):
    placed = number_slots(assign_shards(edge_docs, F.col("doc_id"), [1.0, 1.0]))
    assert placed.count() == edge_docs.count()
    assert len({row["shard"] for row in placed.where("doc_id is null").collect()}) == 1
    assert number_slots(assign_shards(no_docs, F.col("doc_id"), [1.0])).count() == 0
    write_shards(placed, folder + "/shards", files_per_shard=2)
    assert edge_docs.sparkSession.read.parquet(folder + "/shards").count() == edge_docs.count()
