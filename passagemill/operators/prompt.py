"""Prompts from hits and templates, and batch model calls on them."""

from __future__ import annotations

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from passagemill.functions.text import fill_template

QA_TEMPLATE = """You are given passages from a document collection, each under its file name.
Reply to the request at the end in a few words, with what the passages say and nothing else. If they
say nothing about it, reply: not found.

{context}

Request: {question}
"""


def stuff_context(
    hits: DataFrame,
    query_id: str = "query_id",
    content: str = "content",
    sep: str = "\n\n",
    max_chars: int | None = None,
    out: str = "context",
) -> DataFrame:
    """All passages of a question in rank order as one text. A question has at most k passages."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(content).alias("passage"))))
    joined = F.array_join(F.transform(ordered, lambda hit: hit["passage"]), sep)
    if max_chars is not None:
        joined = F.substring(joined, 1, max_chars)
    return hits.groupBy(query_id).agg(joined.alias(out))


def build_prompt(
    questions: DataFrame,
    hits: DataFrame,
    template: str = QA_TEMPLATE,
    query_id: str = "query_id",
    query: str = "query",
    sep: str = "\n\n",
    file: str = "pdf_name",
) -> DataFrame:
    """The questions with their prompt; one without passages gets an empty context.

    Passages are numbered by rank and stand below the name of their file.
    """
    head = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col(file))
    named = hits.withColumn("content", F.concat_ws("\n", head, F.col("content")))
    context = stuff_context(named, query_id, sep=sep)
    return fill_template(
        questions.join(context, query_id, "left"), template, "prompt", question=query
    )


def generate(
    df: DataFrame,
    provider,
    prompt: str = "prompt",
    batch: int = 16,
    out: str = "response",
    on_error: str = "fail",
    max_tokens: int | None = None,
) -> DataFrame:
    """Model replies as a struct (content, error). Stage the result: a reply is never recomputed.

    With ``max_tokens`` the provider is told how long a reply may be.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    reply = StructType([StructField("content", StringType()), StructField("error", StringType())])

    def make():
        predict = provider.make()
        options = {} if max_tokens is None else {"max_tokens": max_tokens}

        def run(prompts) -> list[dict]:
            try:
                return [{"content": text, "error": ""} for text in predict(list(prompts), **options)]
            except Exception as failure:
                if on_error == "fail":
                    raise
                return [{"content": "", "error": str(failure) or "failed"} for _ in prompts]

        return run

    # Batch predictions cannot hold nulls, so an empty error marks success until here.
    call = predict_batch_udf(make, return_type=reply, batch_size=batch).asNondeterministic()
    answered = df.withColumn("_reply", call(F.col(prompt)))
    good = F.col("_reply.error") == ""
    parts = F.struct(
        F.when(good, F.col("_reply.content")).alias("content"),
        F.when(~good, F.col("_reply.error")).alias("error"),
    )
    return answered.withColumn(out, parts).drop("_reply")
