import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm.quality_rules import apply_rules, filter_quality

WORD = r"[^\x20\x09-\x0D]+"


def counted(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = {}
    for at in range(len(words) - 2):
        windows.setdefault(tuple(words[at : at + 3]), []).append(at)
    covered = {at + step for places in windows.values() if len(places) > 1 for at in places for step in range(3)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in apply_rules(rows).collect():
        want = counted(row["text"])
        found = row["quality"]["counts"].asDict()
        assert {name: found[name] for name in want} == want, row["text"]
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert row["quality"]["verdict"]["base_failed"] == failed
        if failed:
            assert not row["quality"]["verdict"]["kept"]


def test_counts_equal_brute_force_on_edges(spark, edge_rows):
    check(spark, [text for _, text in edge_rows])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab #\n\t|é\U0001f600", max_size=60), min_size=20, max_size=40))
def test_counts_equal_brute_force(spark, texts):
    check(spark, texts)


def test_rules_reject_and_keep(spark):
    draw = random.Random(9)
    stock = "the of and to in river stone house light garden was with green morning water road hill".split()
    clean = "\n".join(" ".join(draw.choices(stock, k=10)) for _ in range(20))
    texts = {
        "clean": clean,
        "symbols": " ".join(f"word{at}###" for at in range(80)),
        "lines": "\n".join(["the same line of words is here again"] * 40),
        "capitals": clean.upper(),
        "numbers": " ".join(str(at * 7919) for at in range(100)),
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    kept = {row["doc_id"] for row in apply_rules(rows).where("quality.verdict.kept").collect()}
    assert kept == {"clean"}


def test_filter_keeps_own_columns(edge_docs, no_docs):
    kept = filter_quality(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((row["doc_id"] or 0) for row in kept.collect())
    assert ids == [0, 1, 1, 2]
    assert filter_quality(no_docs).count() == 0


def test_plan_has_no_shuffle_and_no_python(edge_docs, spark):
    plan = apply_rules(edge_docs.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Aggregate" not in plan
