import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.llm.mixing import (
    copies,
    domain_sample,
    fit_domains,
    fit_rates,
    language_targets,
    mix,
    mixed_rates,
    rate_column,
)


def cells(spark, rows):
    return spark.createDataFrame(rows, "grid array<int>, n_tokens long")


def test_expected_shares_come_to_the_targets(spark):
    draw = np.random.default_rng(2)
    rows = []
    for _ in range(500):
        main = int(draw.choice(3, p=[0.7, 0.2, 0.1]))
        soft = int(draw.integers(0, 20))
        grid = [soft // 2] * 3
        grid[main] += 64 - sum(grid)
        rows.append((grid, int(draw.integers(10, 500))))
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    table = cells(spark, rows)
    rates = fit_rates(table, ["a", "b", "c"], targets, most=4.0)
    assert rates.converged and rates.achieved == pytest.approx([0.5, 0.3, 0.2], abs=2e-3)
    rated = table.withColumn("rate", rate_column(F.col("grid"), rates)).collect()
    total = sum(n for _, n in rows)
    shares = sum(row["n_tokens"] * row["rate"] * np.array(row["grid"]) / sum(row["grid"]) for row in rated) / total
    assert shares == pytest.approx([0.5, 0.3, 0.2], abs=2e-3)
    assert all(0 <= row["rate"] <= 4 for row in rated)


def test_rates_equal_a_dense_solver(spark):
    rows = [([64, 0], 100), ([48, 16], 50), ([16, 48], 30), ([0, 64], 20)]
    found = fit_rates(cells(spark, rows), ["a", "b"], {"a": 0.4, "b": 0.6}, most=4.0)
    shares = np.array([[g / 64 for g in grid] for grid, _ in rows])
    tokens = np.array([n for _, n in rows], float) / 200
    rate = np.ones(4)
    for _ in range(200_000):
        error = (tokens * rate @ shares - found.targets) / found.targets
        rate = np.clip(rate - 0.2 * (shares @ error + 1e-3 * (rate - 1)), 0, 4)
    assert found.of(shares) == pytest.approx(rate, abs=5e-3)


def test_bounds_and_missing_domains(spark):
    table = cells(spark, [([64, 0], 900), ([0, 64], 100)])
    rates = fit_rates(table, ["a", "b"], {"a": 0.1, "b": 0.9, "gone": 3.0}, most=4.0)
    assert rates.of(np.array([[0.0, 1.0]]))[0] == pytest.approx(4.0, abs=0.01)
    assert rates.targets == pytest.approx([0.1, 0.9]) and rates.achieved == pytest.approx([0.1, 0.4], abs=0.01)
    free = fit_rates(table, ["a", "b"], {"a": 0.1, "b": 0.9})
    # the error and the pull of 1e-3 in balance, a little below 9
    assert free.of(np.eye(2)) == pytest.approx([1 / 9, 1.001 / (1 / 9 + 0.001)], abs=0.02)
    untouched = fit_rates(table, ["a", "b"], {"gone": 1.0})
    assert untouched.of(np.eye(2)).tolist() == [1.0, 1.0]
    empty = fit_rates(table.where("false"), ["a", "b"], {"a": 1.0})
    assert empty.of(np.eye(2)).tolist() == [1.0, 1.0]


def test_a_domain_is_turned_off_and_a_rare_one_meets_its_target(spark):
    table = cells(spark, [([64, 0, 0, 0], 60_000), ([0, 64, 0, 0], 39_000), ([0, 0, 64, 0], 100), ([0, 0, 0, 64], 900)])
    rates = fit_rates(table, ["a", "off", "rare", "other"], {"a": 0.99, "off": 0.0, "rare": 0.01})
    assert rates.converged
    assert rates.achieved == pytest.approx([0.991 * 0.99, 0.0, 0.991 * 0.01, 0.009], abs=1e-3)
    found = rates.of(np.eye(4))
    assert found[1] == pytest.approx(0.0, abs=1e-3) and found[3] == pytest.approx(1.0, abs=0.02)
    stopped = fit_rates(table, ["a", "off", "rare", "other"], {"a": 0.99, "off": 0.0, "rare": 0.01}, steps=1)
    assert not stopped.converged


def test_twenty_domains_and_a_rare_one_in_a_small_sample(spark):
    rows = [(at, f"own{at % 20} word{at % 20} common", f"d{at % 20:02d}") for at in range(2_000)]
    rows += [(5_000 + at, f"seldom seen text {at}", "rare") for at in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string").repartition(4)
    labelled = docs.select("doc_id", "domain")
    sample = domain_sample(docs, labelled, 300).collect()
    assert len(sample) < 420 and sum(row["domain"] == "rare" for row in sample) == 3
    stands = sum(row["weight"] for row in sample)
    assert stands == pytest.approx(2_003, rel=0.25)
    model = fit_domains(docs, labelled, 300)
    assert len(model.domains) == 21
    truth = {key: domain for key, _, domain in rows}
    posteriors = model.posteriors(docs.select(docs.doc_id.alias("row"), "text")).collect()
    right = sum(model.domains[int(np.argmax(row["grid"]))] == domain for row, domain in
                ((row, truth[row["row"]]) for row in posteriors[:200]))
    assert right > 190
    repeated = docs.unionByName(docs.where("doc_id < 40")).union(docs.where("doc_id < 40"))
    again = domain_sample(repeated, labelled, 10_000)
    assert again.count() == 2_003


def test_rows_without_id_are_drawn_apart(spark):
    rows = spark.range(4_000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    taken = rows.select(copies(F.lit(0.5), F.col("doc_id"), F.col("text")).alias("n"))
    assert taken.agg(F.avg("n")).first()[0] == pytest.approx(0.5, abs=0.04)


def test_classifier_tells_languages(spark, edge_docs, no_docs):
    rows = [(at, f"the river and the stone {at}" if at % 3 else f"le fleuve et la pierre {at}", "en" if at % 3 else "fr") for at in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string").repartition(4)
    labelled = docs.where("doc_id % 2 = 0").select("doc_id", "domain")
    rated, rates = mixed_rates(docs.select("doc_id", "text"), labelled, {"en": 0.5, "fr": 0.5})
    assert rates.domains == ["en", "fr"]
    found = {row["doc_id"]: row for row in rated.select("row.doc_id", "grid", "rate", "copies").collect()}
    for at, _, domain in rows:
        assert (found[at]["grid"][0] > 32) == (domain == "en")
        assert abs(found[at]["copies"] - found[at]["rate"]) < 1
    mixed = mix(edge_docs, labelled, {"en": 0.5, "fr": 0.5})
    assert mixed.columns == edge_docs.columns
    mixed.collect()
    assert mix(no_docs, labelled, {"en": 1.0}).count() == 0
    nothing = fit_domains(docs, labelled.where("false"))
    assert nothing.classifier is None
    assert mix(edge_docs, labelled.where("false"), language_targets()).count() == edge_docs.count()


def test_copies_have_the_rate_as_their_mean(spark):
    rows = spark.range(20_000).select(copies(F.lit(1.3), F.col("id")).alias("n"))
    assert rows.agg(F.avg("n")).first()[0] == pytest.approx(1.3, abs=0.02)
