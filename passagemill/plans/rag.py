"""The retrieval pipelines: documents to an embedded chunk table, questions to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.operators.answer import ANSWER_TOKENS, extractive_answer
from passagemill.operators.chunk import CHUNK_OVERLAP, CHUNK_SIZE, chunk_sentences
from passagemill.operators.embed import (
    HASH_DIM,
    HashEmbedder,
    ModelEmbedder,
    embed,
    hash_embed,
)
from passagemill.operators.extract import extract_text, extract_with
from passagemill.operators.index import VectorIndex, vector_topk_indexed
from passagemill.operators.keys import add_content_key
from passagemill.operators.prompt import QA_TEMPLATE, build_prompt, generate
from passagemill.operators.vector_search import vector_topk, with_columns
from passagemill.session import stage
from passagemill.sources.writers import write_append

Embedder = HashEmbedder | ModelEmbedder

#: Files that a parser holds at once.
PARSED_FILES = 10


def chunk_documents(
    files: DataFrame,
    content: str = "content",
    kind: str = "html",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    make_parser=None,
    tokenizer=None,
) -> DataFrame:
    """File rows to chunk rows (…, chunk_no, content): extract, then pack sentences.

    ``make_parser`` takes the place of the built-in extraction, for other file formats;
    ``tokenizer`` counts the chunks' tokens like the model that will read them.
    """
    if make_parser is None:
        texts = extract_text(files, content, kind)
    else:
        texts = stage(extract_with(files, make_parser, content), "texts", arrow_rows=PARSED_FILES)
    return chunk_sentences(texts, "text", size, overlap, tokenizer=tokenizer)


def _keyed(chunks: DataFrame) -> DataFrame:
    return add_content_key(chunks, ["pdf_name", "chunk_no", "content"])


def embed_documents(
    chunks: DataFrame, dim: int = HASH_DIM, embedder: Embedder | None = None
) -> DataFrame:
    """Chunk rows (pdf_name, chunk_no, content) to table rows (id, pdf_name, content, embedding)."""
    embedder = embedder or HashEmbedder(dim)
    return embedder.add(_keyed(chunks)).select("id", "pdf_name", "content", "embedding")


def add_documents(
    chunks: DataFrame,
    table: str,
    provider=None,
    dim: int = HASH_DIM,
    path: str | None = None,
) -> None:
    """Embed the chunks whose key the table does not hold yet, and append them.

    Chunks already in the table are dropped before embedding, so a rerun pays for no vector again.
    Without a provider the hashing embedder is used.
    """
    spark = chunks.sparkSession
    fresh = _keyed(chunks).select("id", "pdf_name", "content").dropDuplicates(["id"])
    if spark.catalog.tableExists(table):
        fresh = fresh.join(spark.table(table).select("id"), "id", "left_anti")
    vectors = hash_embed(fresh, dim=dim) if provider is None else embed(fresh, provider)
    write_append(vectors.select("id", "pdf_name", "content", "embedding"), table, path=path)


def embed_queries(
    questions: DataFrame,
    query: str = "query",
    dim: int = HASH_DIM,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Questions with vectors from the same embedder as the chunks."""
    return (embedder or HashEmbedder(dim)).add(questions, query)


def batch_retrieve(
    questions: DataFrame,
    base: DataFrame | VectorIndex,
    k: int = 2,
    metric: str = "cosine",
    dim: int = HASH_DIM,
    query_id: str = "query_id",
    embedder: Embedder | None = None,
    probes: int | None = None,
) -> DataFrame:
    """The k best chunks for every question in one search, with their file and text.

    ``base`` is a chunk table, which is searched whole, or its vector index, of which each question
    meets the nearest ``probes`` cells (all if not given). The index must hold vectors of the same
    embedder: its name and width are checked.
    """
    embedder = embedder or HashEmbedder(dim)
    asked = embed_queries(questions.select(query_id, "query"), embedder=embedder)
    if isinstance(base, VectorIndex):
        given = (embedder.name, embedder.dim)
        count = probes or len(base.centroids)
        wide = ["pdf_name", "content"]
        return vector_topk_indexed(asked, base, given, k, count, metric, query_id, columns=wide)
    hits = vector_topk(asked, base, embedder.dim, k, metric, query_id)
    return with_columns(hits, base, ["pdf_name", "content"])


def answer_questions(
    questions: DataFrame,
    base: DataFrame | VectorIndex,
    k: int = 2,
    template: str = QA_TEMPLATE,
    max_tokens: int = ANSWER_TOKENS,
    dim: int = HASH_DIM,
    query_id: str = "query_id",
    embedder: Embedder | None = None,
    model=None,
    probes: int | None = None,
) -> DataFrame:
    """Retrieve once, then prompt and answer from the same hits: query_id, query, prompt, result.

    ``model`` is a provider that replies to prompts; without one the best sentence of the passages
    is the answer.
    """
    hits = batch_retrieve(
        questions, base, k, dim=dim, query_id=query_id, embedder=embedder, probes=probes
    )
    prompts = build_prompt(questions.select(query_id, "query"), hits, template, query_id)
    if model is None:
        return extractive_answer(prompts.drop("context"), hits, max_tokens, query_id)
    replies = stage(generate(prompts.drop("context"), model, max_tokens=max_tokens), "replies")
    return replies.select(query_id, "query", "prompt", F.col("response.content").alias("result"))
