"""Headline timings: median of three warm runs per query, session start excluded.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS``; prints one JSON line. Queries
over the chunk table and its index are also timed on stored ones (``stored_*``), so that the set-up is
not part of the time; ``build_index`` is that set-up. The tables are first written as one file for each
core.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import queries as checks
from checks.compare import TABLES, session
from checks.queries import QUERIES
from passagemill.operators.embed import HASH_DIM
from passagemill.operators.index import build_index, vector_topk_indexed
from passagemill.plans.rag import answer_questions, batch_retrieve, embed_queries
from passagemill.session import new_path, stage

HEADLINE = [
    "chunk_windows",
    "chunk_sentences",
    "hash_embed",
    "embed_documents",
    "vector_topk_cosine",
    "vector_topk_l2",
    "keyword_topk",
    "rerank_overlap",
    "rag_answer",
    "change_rows",
    "apply_changes",
    "sync_index",
    "eval_summary",
    "count_by_location",
]
RUNS = 3


def stored(spark, sf_dir: str) -> dict:
    """Queries over a chunk table and an index that are there already."""
    base = stage(checks._chunk_table(spark, sf_dir), "bench-chunks")
    questions = checks._questions(spark, sf_dir)
    index = build_index(base, new_path(spark, "bench-index"), dim=HASH_DIM)
    asked = stage(embed_queries(questions), "bench-questions")
    return {
        "build_index": lambda: build_index(base, new_path(spark, "bench-index"), dim=HASH_DIM).rows(spark),
        "stored_exact_search": lambda: batch_retrieve(questions, base, 5),
        "stored_index_search": lambda: vector_topk_indexed(asked, index, ("hashing", HASH_DIM), 5, 4),
        "stored_rag_answer": lambda: answer_questions(questions, index, probes=4),
    }


def spread(spark, sf_dir: str, files: int) -> str:
    """The tables written once as so many files each, as a large input would lie there.

    A table of one file with one row group is one task, whatever the query does.
    """
    folder = new_path(spark, "bench-input")
    for table in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        rows.repartition(files).write.parquet(f"{folder}/{table}.parquet")
    return folder


def timed(query) -> float:
    began = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = session(cpus)
    given, sf_dir = sf_dir, spread(spark, sf_dir, int(cpus))
    all_queries = {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in HEADLINE}
    all_queries |= stored(spark, sf_dir)
    timings = {}
    for name, query in all_queries.items():
        timed(query)
        timings[name] = round(statistics.median(timed(query) for _ in range(RUNS)), 3)
    curve = QUERIES["ivf_recall"](spark, sf_dir).orderBy("probes").collect()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "ivf_recall_at_5_by_probes": {row["probes"]: row["recall"] for row in curve},
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
