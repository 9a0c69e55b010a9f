"""One query per operator, over the whole given tables."""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagemill.functions.fields import (
    first_present,
    reply_field,
    state_by_word,
    vector_head,
)
from passagemill.functions.text import (
    clean_code,
    fill_template,
    filled,
    join_lines,
    plain_elements,
    terms,
    token_count,
    truncated,
    without,
)
from passagemill.operators.answer import extractive_answer
from passagemill.operators.changes import (
    apply_changes,
    diff_snapshots,
    live,
    versioned,
)
from passagemill.operators.chunk import (
    chunk_sentences,
    chunk_windows,
    count_tokens_with,
    split_sentences,
)
from passagemill.operators.embed import HASH_DIM, check_vectors, embed, hash_embed
from passagemill.operators.evaluate import (
    answer_relevance,
    answer_similarity,
    context_text,
    eval_dataset,
    evaluate_by,
    evaluate_rows,
    evaluate_summary,
    judged,
    token_f1,
)
from passagemill.operators.extract import extract_text
from passagemill.operators.index import (
    build_index,
    describe_index,
    open_index,
    recall_by_probes,
    rows_per_cell,
    vector_topk_bounded,
    vector_topk_indexed,
)
from passagemill.operators.keys import add_content_key, add_dense_id
from passagemill.operators.keyword_search import (
    corpus_totals,
    document_frequency,
    keyword_lookup,
    keyword_topk,
    two_hop_lookup,
)
from passagemill.operators.prompt import build_prompt, generate, stuff_context
from passagemill.operators.rerank import rerank_overlap, rerank_with
from passagemill.operators.summary import chart_top_groups, count_by, count_rows
from passagemill.operators.vector_search import passages, vector_topk, with_columns
from passagemill.plans.chain import stage_assign, stage_map, stage_pipe
from passagemill.plans.rag import (
    add_documents,
    answer_questions,
    batch_retrieve,
    chunk_documents,
    embed_documents,
    embed_queries,
)
from checks.text_models import (
    FirstTokensModel,
    HashingEmbedder,
    PieceCounter,
    WordShareScorer,
)
from passagemill.session import new_path, stage, staged_meanwhile
from passagemill.sources.change_log import (
    diff_versions,
    keep_changes,
    read_changes,
    read_version,
)
from passagemill.sources.readers import (
    parse_csv_lines,
    read_binary_files,
    read_csv_file,
    read_one_file,
    read_table,
)
from passagemill.sources.writers import (
    create_table_if_absent,
    preview,
    set_change_feed,
    write_append,
    write_evolved,
    write_files,
    write_overwrite,
)
from passagemill.streaming.sync import (
    append_changes,
    create_or_sync,
    replace_table,
    sync_index_log,
)

# ---- inputs


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", columns or None)


def _documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _table(spark, sf, "documents", *columns)


def _pdf_name() -> Column:
    return F.concat_ws("/", "source", "doc_id").alias("pdf_name")


def _document_chunks(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    docs = _documents(spark, sf, "doc_id", "source", "text", *columns)
    return chunk_sentences(docs.select(_pdf_name(), "text", *columns))


def _chunk_table(spark: SparkSession, sf: str) -> DataFrame:
    """The embedded chunk table, written once: no later step computes a vector again."""
    return stage(embed_documents(_document_chunks(spark, sf)), "chunks")


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _vector_questions(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf).select(F.col("id").alias("query_id"), "embedding")


def _temporary_table(spark: SparkSession) -> tuple[str, str]:
    path = new_path(spark, "table")
    return "t_" + path.rsplit("-", 1)[1], path


# ---- sources and sinks


def _page_files(spark: SparkSession, sf: str) -> str:
    """Every page as a text file of its own, below one folder per page."""
    path = new_path(spark, "pages")
    pages = _table(spark, sf, "pages")
    line = F.regexp_replace("html", "[\\r\\n]+", " ").alias("value")
    tasks = 4 * spark.sparkContext.defaultParallelism
    write_files(pages.select("page_id", line), path, "page_id", "value", tasks)
    return path


def src_binary_files(spark, sf):
    files = read_binary_files(spark, _page_files(spark, sf), glob="*.txt")
    text = F.decode("content", "UTF-8")
    return files.select(
        F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("bigint").alias("page_id"),
        "length",
        F.md5(F.encode(F.regexp_replace(text, "\n$", ""), "UTF-8")).alias("digest"),
    )


def src_one_file(spark, sf):
    """The one file of each page's folder, found by its name."""
    files = read_binary_files(spark, _page_files(spark, sf), glob="*.txt")
    page = F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("bigint")
    name = F.min(F.regexp_extract("path", "page_id=[^/]+/[^/]+$", 0))
    # opened before the names are looked up, so that no content is dealt by page
    opened = files.select("path", page.alias("page_id"), F.octet_length("content").cast("bigint").alias("length"))
    named = opened.withColumn("name", name.over(Window.partitionBy("page_id")))
    return read_one_file(named, F.col("name")).select("page_id", "length")


def src_table_scan(spark, sf):
    return _table(spark, sf, "documents", "doc_id", "lang", "source", "n_chars")


def src_csv_file(spark, sf):
    path = new_path(spark, "csv")
    turns = _table(spark, sf, "conversations")
    (
        turns.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv_file(spark, path, turns.schema, multi_line=True)


def src_csv_lines(spark, sf):
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    episode = F.when(F.col("turn") == 0, "TRUE").otherwise("FALSE")
    lines = _table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat_ws(",", quoted, "role", episode).alias("line")
    )
    schema = "question string, evolution_type string, episode_done boolean"
    return parse_csv_lines(lines, "line", schema)


def sink_overwrite(spark, sf):
    name, path = _temporary_table(spark)
    labels = _table(spark, sf, "labels")
    write_overwrite(labels.where("toxic = 1"), name, path)
    write_overwrite(labels, name, path)
    return read_table(spark, name, ["doc_id", "quality", "toxic"])


def sink_append_dedup(spark, sf):
    name, path = _temporary_table(spark)
    rows = add_content_key(_documents(spark, sf), ["text"]).select("id", "n_chars")
    # The same load twice: the second run finds every key already there.
    write_append(rows, name, "id", path)
    write_append(rows, name, "id", path)
    return read_table(spark, name)


def sink_create_table(spark, sf):
    name, path = _temporary_table(spark)
    labels = _table(spark, sf, "labels")
    create_table_if_absent(spark, name, labels.schema, path)
    create_table_if_absent(spark, name, labels.schema, path)
    set_change_feed(spark, name)
    write_append(labels, name, path=path)
    return read_table(spark, name)


def sink_evolve_schema(spark, sf):
    name, path = _temporary_table(spark)
    write_overwrite(_table(spark, sf, "documents", "doc_id", "lang", "text"), name, path)
    keyed = add_content_key(read_table(spark, name), ["doc_id", "text"]).drop("text")
    return write_evolved(keyed, name).select("doc_id", "lang", "id")


def sink_change_feed(spark, sf):
    name, path = _temporary_table(spark)
    first, second, _ = _snapshots(spark, sf)
    feed = new_path(spark, "feed")
    write_overwrite(first, name, path)
    set_change_feed(spark, name)
    replace_table(second, name, "doc_id", 1, feed)
    return read_table(spark, feed)


def sink_change_feed_added_column(spark, sf):
    """A column is added while the change feed is on: it counts as null in the old rows."""
    name, path = _temporary_table(spark)
    first, second, _ = _snapshots(spark, sf)
    feed = new_path(spark, "feed")
    write_overwrite(first, name, path)
    set_change_feed(spark, name)
    sized = second.withColumn("size", F.length("content").cast("bigint"))
    replace_table(sized, name, "doc_id", 1, feed)
    held = spark.table(name).select("doc_id", F.col("size").alias("held_size"))
    return read_table(spark, feed).join(held, "doc_id", "left")


def _logged_table(spark: SparkSession, sf: str) -> str:
    """The first snapshot as a table whose changes are kept."""
    name, path = _temporary_table(spark)
    write_overwrite(_snapshots(spark, sf)[0], name, path)
    keep_changes(spark, name, "doc_id")
    return name


def append_change_feed(spark, sf):
    """Appending the second snapshot inserts the documents that the first lacks; a rerun adds nothing."""
    name = _logged_table(spark, sf)
    for _ in range(2):
        write_append(_snapshots(spark, sf)[1], name, txn="second")
        write_append(_snapshots(spark, sf)[1], name)
    return read_changes(spark, name)


def overwrite_change_feed(spark, sf):
    """Overwriting logs inserts, deletes and both images of each update."""
    name = _logged_table(spark, sf)
    for _ in range(2):
        write_overwrite(_snapshots(spark, sf)[1], name, txn="second")
    return read_changes(spark, name)


def table_version(spark, sf):
    """The second version of three, after an append on top."""
    name = _logged_table(spark, sf)
    first, second, third = _snapshots(spark, sf)
    write_overwrite(second, name)
    write_overwrite(third, name)
    write_append(first, name)
    return read_version(spark, name, 1)


def version_diff(spark, sf):
    """Net changes over two overwrites and an append."""
    name = _logged_table(spark, sf)
    first, second, third = _snapshots(spark, sf)
    write_overwrite(third, name)
    write_overwrite(second, name)
    write_append(first, name)
    return diff_versions(spark, name, 0, 2)


def sync_index_appends(spark, sf):
    """Chunks appended to a logged table reach its index by triggered syncs."""
    name, location = _temporary_table(spark)
    first, second, third = (hash_embed(rows, dim=64) for rows in _snapshots(spark, sf))
    path, checkpoint = (new_path(spark, n) for n in ("index", "checkpoint"))
    write_overwrite(first, name, location)
    keep_changes(spark, name, "doc_id")
    build_index(spark.table(name), path, key="doc_id", dim=64, cells=8)
    for rows in (second, third):
        write_append(rows, name)
        sync_index_log(spark, name, path, checkpoint)
    return open_index(spark, path).rows(spark).select("doc_id", "content", "_commit_version")


def preview_topn(spark, sf):
    return preview(_table(spark, sf, "documents", "source", "doc_id", "n_chars"), 20, ["source", "doc_id"])


# ---- columns


def project_rename(spark, sf):
    docs = _table(spark, sf, "documents")
    return docs.withColumn("size", F.length("text").cast("bigint")).selectExpr(
        "doc_id", "source as pdf_name", "text as content", "size"
    )


def elements_nonempty(spark, sf):
    elements = plain_elements(F.col("text"))
    return _documents(spark, sf).select(
        "doc_id",
        join_lines(elements).alias("content"),
        F.size(elements).cast("bigint").alias("element_count"),
    )


def explode_elements(spark, sf):
    return (
        _documents(spark, sf)
        .select("doc_id", F.posexplode(plain_elements(F.col("text"))).alias("position", "element"))
        .withColumn("position", F.col("position").cast("bigint"))
    )


def vector_prefix(spark, sf):
    return (
        _vectors(spark, sf)
        .select("id", F.posexplode(vector_head(F.col("embedding"))).alias("position", "value"))
        .select("id", F.col("position").cast("bigint"), F.col("value").cast("double"))
    )


def text_replace(spark, sf):
    return _table(spark, sf, "documents").select(
        "doc_id", without(F.col("text"), ",").alias("content")
    )


def text_truncate(spark, sf):
    return _table(spark, sf, "documents").select(
        "doc_id", truncated(F.col("text"), 100).alias("snippet")
    )


def prompt_format(spark, sf):
    docs = _table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    template = "Sum up this {language} text from {source} in {language}:\n{text}"
    return fill_template(docs, template, language="lang").select("doc_id", "prompt")


def coalesce_fields(spark, sf):
    state = first_present(
        reply_field(F.when(F.col("event_id") % 2 == 0, F.col("props")), "k"),
        F.col("event_type"),
        default="UNKNOWN",
    )
    words = {"ERR": "failed", "SIGN": "provisioning", "VIEW": "online"}
    return _table(spark, sf, "events").select(
        "event_id",
        F.upper(state).alias("state"),
        state_by_word(state, words, "unknown").alias("kind"),
    )


def passages_format(spark, sf):
    hits = vector_topk(_vector_questions(spark, sf), _vectors(spark, sf), 64, 2)
    docs = _table(spark, sf, "documents")
    found = with_columns(hits, docs, ["source", "text"], "doc_id")
    return passages(found, "source", "text").select("query_id", "rank", "file", "text")


def clean_code_input(spark, sf):
    reply = F.concat(F.lit(" ```python\n"), F.col("text"), F.lit("\n``` "))
    return _table(spark, sf, "conversations").select(
        "conv_id", "turn", clean_code(reply).alias("code")
    )


def reply_field_(spark, sf):
    return _table(spark, sf, "events").select(
        "event_id", reply_field(F.col("props"), "k").alias("reply")
    )


# ---- text, chunks, vectors


def extract_html_text(spark, sf):
    pages = _table(spark, sf, "pages").select(
        "page_id", F.encode("html", "UTF-8").alias("content")
    )
    return extract_text(pages)


def split_sentences_(spark, sf):
    return split_sentences(_documents(spark, sf, "doc_id", "text"))


def count_tokens(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", token_count(F.col("text")).cast("bigint").alias("tokens")
    )


def count_tokens_model(spark, sf):
    docs = _documents(spark, sf, "doc_id", "text")
    return count_tokens_with(docs, PieceCounter()).select("doc_id", "tokens")


def chunk_windows_(spark, sf):
    return chunk_windows(_documents(spark, sf, "doc_id", "text"))


def chunk_sentences_(spark, sf):
    return chunk_sentences(_documents(spark, sf, "doc_id", "text"))


def chunk_documents_(spark, sf):
    files = _table(spark, sf, "pages").select(
        F.col("url").alias("pdf_name"), "page_id", F.encode("html", "UTF-8").alias("content")
    )
    return chunk_documents(files, size=120, overlap=20)


def _cells(vectors: DataFrame, key: str) -> DataFrame:
    """Non-zero vector entries as rows."""
    return (
        vectors.select(key, F.posexplode("embedding").alias("dim", "weight"))
        .where("weight <> 0")
        .select(key, F.col("dim").cast("bigint"), F.col("weight").cast("double"))
    )


def hash_embed_(spark, sf):
    return _cells(hash_embed(_documents(spark, sf, "doc_id", "text"), "text"), "doc_id")


def embed_batches(spark, sf):
    docs = _documents(spark, sf, "doc_id", "text")
    return _cells(stage(embed(docs, HashingEmbedder(), "text"), "vectors"), "doc_id")


def embed_queries_(spark, sf):
    return _cells(embed_queries(_questions(spark, sf)), "query_id")


def check_vectors_(spark, sf):
    vector = F.col("embedding")
    damaged = _vectors(spark, sf).withColumn(
        "embedding",
        F.when(F.col("label") == 1, F.slice(vector, 1, 20))
        .when(F.col("label") == 2, F.transform(vector, lambda x: (x * 0).cast("float")))
        .when(F.col("label") == 3, F.transform(vector, lambda x: F.lit("NaN").cast("float")))
        .when(F.col("label") == 4, F.lit(None))
        .otherwise(vector),
    )
    good, bad = check_vectors(damaged, 64)
    return good.select("id", F.lit("none").alias("fault")).unionByName(bad.select("id", "fault"))


def _embedded(table: DataFrame) -> DataFrame:
    return table.select(
        "id",
        "pdf_name",
        "content",
        F.size(F.filter("embedding", lambda x: x != 0)).cast("bigint").alias("filled"),
    )


def embed_documents_(spark, sf):
    return _embedded(embed_documents(_document_chunks(spark, sf)))


def embed_documents_append(spark, sf):
    """English and French documents first, then all: only the chunks still missing are embedded."""
    name, path = _temporary_table(spark)
    chunks = _document_chunks(spark, sf, "lang")
    add_documents(chunks.where("lang in ('en', 'fr')"), name, path=path)
    add_documents(chunks, name, HashingEmbedder(), path=path)
    return _embedded(read_table(spark, name))


# ---- keys, changes, index


def content_key(spark, sf):
    rows = _table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    return add_content_key(rows, ["source", "doc_id", "text"]).select("doc_id", "id")


def dense_id(spark, sf):
    rows = _table(spark, sf, "documents", "lang", "doc_id")
    return add_dense_id(rows, ["lang", "doc_id"])


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three states of a document table: the labelled texts; all texts but the toxic ones, without
    commas; all texts but the poor ones, as they are."""
    docs = _documents(spark, sf, "doc_id", "text")
    labels = _table(spark, sf, "labels")
    content = F.col("text").alias("content")
    first = docs.join(labels, "doc_id", "left_semi").select("doc_id", content)
    second = docs.join(labels.where("toxic = 1"), "doc_id", "left_anti").select(
        "doc_id", without(F.col("text"), ",").alias("content")
    )
    third = docs.join(labels.where("quality = 0"), "doc_id", "left_anti").select("doc_id", content)
    return first, second, third


def change_rows(spark, sf):
    first, second, _ = _snapshots(spark, sf)
    return diff_snapshots(first, second, "doc_id", 1)


def apply_changes_(spark, sf):
    first, second, third = _snapshots(spark, sf)
    changes = diff_snapshots(first, second, "doc_id", 1).unionByName(
        diff_snapshots(second, third, "doc_id", 2)
    )
    return apply_changes(versioned(first, 0), changes, "doc_id")


def sync_index(spark, sf):
    """Build the index from the first state, then take on two sets of changes by two triggers."""
    feed, path, checkpoint = (new_path(spark, n) for n in ("feed", "index", "checkpoint"))
    build = dict(key="doc_id", dim=64, cells=4)
    with ExitStack() as states:
        first, second, third = (
            states.enter_context(staged_meanwhile(hash_embed(state, dim=64), "state"))
            for state in _snapshots(spark, sf)
        )
        changes = [
            diff_snapshots(old, new, "doc_id", version)
            for old, new, version in ((first, second, 1), (second, third, 2))
        ]
        for coming in (None, *changes):
            if coming is not None:
                append_changes(coming, feed)
            if coming is changes[-1]:
                states.close()  # all changes are in the feed
            create_or_sync(spark, first, feed, changes[0].schema, path, checkpoint, **build)
    return open_index(spark, path).rows(spark).select(
        "doc_id", "content", F.size("embedding").cast("bigint").alias("width")
    )


def _vector_index(spark: SparkSession, sf: str):
    path = new_path(spark, "index")
    return build_index(_vectors(spark, sf), path, dim=64, cells=16, embedder="given")


def index_stats(spark, sf):
    return describe_index(spark, _vector_index(spark, sf).path)


def index_cells(spark, sf):
    return rows_per_cell(spark, _label_index(spark, sf).path)


# ---- search


def vector_topk_cosine(spark, sf):
    return vector_topk(_vector_questions(spark, sf), _vectors(spark, sf), 64, 5, "cosine")


def vector_topk_l2(spark, sf):
    return vector_topk(_vector_questions(spark, sf), _vectors(spark, sf), 64, 5, "l2")


def vector_topk_dot(spark, sf):
    return vector_topk(_vector_questions(spark, sf), _vectors(spark, sf), 64, 5, "dot")


def vector_topk_ivf(spark, sf):
    index = _vector_index(spark, sf)
    questions = _vector_questions(spark, sf)
    curve = stage(recall_by_probes(questions, index, 5), "recall")
    chosen = curve.where("recall >= 0.9").orderBy("probes").first()
    hits = vector_topk_indexed(questions, index, ("given", 64), 5, chosen["probes"])
    return hits.withColumn("recall", F.lit(chosen["recall"]))


def vector_topk_ivf_all_cells(spark, sf):
    index = _vector_index(spark, sf)
    return vector_topk_indexed(
        _vector_questions(spark, sf), index, ("given", 64), 5, len(index.centroids)
    )


def vector_topk_ivf_bounded(spark, sf):
    """Exact search that reads only cells which can hold a hit."""
    index = _vector_index(spark, sf)
    hits = vector_topk_bounded(_vector_questions(spark, sf), index, ("given", 64), 5, 2)
    return hits.select("query_id", "rank", "id", "score")


def _label_index(spark: SparkSession, sf: str):
    """Cells with known centres: the mean vector of every label."""
    rows = _vectors(spark, sf)
    means = (
        rows.select("label", F.posexplode("embedding").alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("entries"))
        .select("label", F.col("entries.x").alias("centre"))
    )
    centres = [row["centre"] for row in means.orderBy("label").collect()]  # one row per label
    path = new_path(spark, "index")
    return build_index(rows, path, dim=64, embedder="given", centroids=np.array(centres))


def vector_topk_ivf_label_cells(spark, sf):
    index = _label_index(spark, sf)
    return vector_topk_indexed(_vector_questions(spark, sf), index, ("given", 64), 5, 3, "l2")


def ivf_recall(spark, sf):
    return recall_by_probes(_vector_questions(spark, sf), _label_index(spark, sf), 5, "l2")


def search_columns(spark, sf):
    hits = vector_topk(_vector_questions(spark, sf), _vectors(spark, sf), 64, 5)
    return with_columns(hits, _vectors(spark, sf), ["label"])


def keyword_topk_(spark, sf):
    docs = _documents(spark, sf, "doc_id", "text")
    return keyword_topk(_questions(spark, sf), docs, 3, doc_id="doc_id", doc_text="text")


def keyword_topk_stored(spark, sf):
    """The same search with the corpus figures computed and stored beforehand."""
    docs = _documents(spark, sf, "doc_id", "text")
    counts = stage(document_frequency(docs, "text"), "term-counts")
    totals = stage(corpus_totals(docs, "text"), "totals")
    return keyword_topk(
        _questions(spark, sf),
        docs,
        3,
        doc_id="doc_id",
        doc_text="text",
        term_counts=counts,
        totals=totals,
    )


def keyword_top1_truncated(spark, sf):
    docs = _documents(spark, sf, "doc_id", "text")
    return keyword_lookup(_questions(spark, sf), docs, 100, doc_id="doc_id", doc_text="text")


def _candidates(spark: SparkSession, sf: str, base: DataFrame) -> DataFrame:
    questions = _questions(spark, sf)
    return stage(batch_retrieve(questions, base, 5).join(questions, "query_id"), "candidates")


def rerank_overlap_(spark, sf):
    base = _chunk_table(spark, sf)
    counts = document_frequency(base)
    total = base.agg(F.count("*")).scalar()
    found = rerank_overlap(_candidates(spark, sf, base), counts, total)
    return found.select("query_id", "rank", "id", "score")


def rerank_model(spark, sf):
    candidates = _candidates(spark, sf, _chunk_table(spark, sf))
    return rerank_with(candidates, WordShareScorer()).select("query_id", "rank", "id", "score")


def batch_retrieve_(spark, sf):
    return batch_retrieve(_questions(spark, sf), _chunk_table(spark, sf), 2)


def two_hop_lookup_(spark, sf):
    base = _chunk_table(spark, sf)
    first = batch_retrieve(_questions(spark, sf), base, 1)
    pages = extract_text(_table(spark, sf, "pages", "page_id", "html"), "html")
    return two_hop_lookup(first, pages, doc_id="page_id", doc_text="text")


# ---- prompts, answers, chains


def stuff_context_(spark, sf):
    hits = batch_retrieve(_questions(spark, sf), _chunk_table(spark, sf), 3)
    return stuff_context(hits)


def build_prompt_(spark, sf):
    questions = _questions(spark, sf)
    hits = batch_retrieve(questions, _chunk_table(spark, sf), 2)
    return build_prompt(questions, hits).select("query_id", "prompt")


def generate_(spark, sf):
    docs = _documents(spark, sf, "doc_id", "text")
    prompts = fill_template(docs, "Answer in brief: {text}").select("doc_id", "prompt")
    replies = stage(generate(prompts, FirstTokensModel(300)), "replies")
    return replies.select("doc_id", F.col("response.content").alias("reply"))


def extractive_answer_(spark, sf):
    """Answers from the two documents that keyword search finds."""
    questions = _questions(spark, sf)
    docs = _documents(spark, sf, "doc_id", "text")
    hits = keyword_topk(questions, docs, 2, doc_id="doc_id", doc_text="text")
    found = with_columns(hits, docs.withColumnRenamed("text", "content"), ["content"], "doc_id")
    return extractive_answer(questions, found, 20).select("query_id", "result")


def rag_answer(spark, sf):
    """Answers through the vector index of the chunk table, all cells probed."""
    index = build_index(_chunk_table(spark, sf), new_path(spark, "index"), dim=HASH_DIM)
    answers = answer_questions(_questions(spark, sf), index)
    return answers.select("query_id", "query", "prompt", "result")


def chain_pipe(spark, sf):
    """Template, model call, text of the reply."""

    def prompted(df: DataFrame) -> DataFrame:
        return fill_template(df, "In plain words, tell a newcomer about this: {query}")

    def answered(df: DataFrame) -> DataFrame:
        return generate(df, FirstTokensModel(12))

    def parsed(df: DataFrame) -> DataFrame:
        return df.select("query_id", F.col("response.content").alias("answer"))

    return _questions(spark, sf).transform(stage_pipe(prompted, answered, parsed))


def _chain_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", F.col("text").alias("question"), F.col("source").alias("videos"))


def _chain_stages() -> dict:
    def counted(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.size(terms(F.col("question"))).cast("bigint").alias("terms"))

    return {
        "c": filled("Answer this: {question}", {"question": F.col("question")}),
        "d": filled("Watch {videos}", {"videos": F.col("videos")}),
        "e": counted,
    }


def chain_map(spark, sf):
    return _chain_inputs(spark, sf).transform(stage_map("doc_id", **_chain_stages()))


def chain_assign(spark, sf):
    mapped = stage_map("doc_id", **_chain_stages())
    again = stage_assign(d=filled("Again: {d}", {"d": F.col("d")}))
    return _chain_inputs(spark, sf).transform(stage_pipe(mapped, again))


# ---- evaluation


def _eval_questions(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the reply that follows as ground truth."""
    turns = _table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("query"))
    replies = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ground_truth")
    )
    kind = F.when(token_count(F.col("query")) <= 20, "simple").otherwise("reasoning")
    return asked.join(replies, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("query_id"),
        "query",
        "ground_truth",
        kind.alias("evolution_type"),
    )


def _eval_rows(spark: SparkSession, sf: str) -> DataFrame:
    questions = stage(_eval_questions(spark, sf), "questions")
    base = _chunk_table(spark, sf)
    hits = stage(batch_retrieve(questions, base, 2), "hits")
    answers = extractive_answer(questions, hits)
    rows = eval_dataset(questions, answers, hits)
    return stage(
        rows.join(questions.select("query_id", "evolution_type"), "query_id"), "eval"
    )


def eval_dataset_(spark, sf):
    return context_text(_eval_rows(spark, sf)).drop("evolution_type")


def eval_similarity(spark, sf):
    return answer_similarity(_eval_rows(spark, sf))


def eval_token_f1(spark, sf):
    return token_f1(_eval_rows(spark, sf))


def eval_relevance(spark, sf):
    return answer_relevance(_eval_rows(spark, sf))


def eval_judged(spark, sf):
    graded = judged(_eval_rows(spark, sf), WordShareScorer(), ("ground_truth", "answer"))
    return graded.select("query_id", "judged")


def eval_rows(spark, sf):
    return context_text(evaluate_rows(_eval_rows(spark, sf)))


def eval_summary(spark, sf):
    return evaluate_summary(evaluate_rows(_eval_rows(spark, sf)))


def eval_by_group(spark, sf):
    return evaluate_by(evaluate_rows(_eval_rows(spark, sf)), "evolution_type")


# ---- counts


def count_by_location(spark, sf):
    nations = _table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    counts = count_by(_table(spark, sf, "customer", "c_nationkey"), "c_nationkey")
    return counts.join(nations, "c_nationkey").select("n_name", "row_count")


def count_rows_(spark, sf):
    return count_rows(_table(spark, sf, "lineitem"))


def chart_top_groups_(spark, sf):
    return chart_top_groups(_table(spark, sf, "events"), "event_type", "value", 3)


QUERIES = {
    function.__name__.removesuffix("_"): function
    for function in (
        src_binary_files,
        src_one_file,
        src_table_scan,
        src_csv_file,
        src_csv_lines,
        sink_overwrite,
        sink_append_dedup,
        sink_create_table,
        sink_evolve_schema,
        sink_change_feed,
        sink_change_feed_added_column,
        append_change_feed,
        overwrite_change_feed,
        table_version,
        version_diff,
        sync_index_appends,
        preview_topn,
        project_rename,
        elements_nonempty,
        explode_elements,
        vector_prefix,
        text_replace,
        text_truncate,
        prompt_format,
        coalesce_fields,
        passages_format,
        clean_code_input,
        reply_field_,
        extract_html_text,
        split_sentences_,
        count_tokens,
        count_tokens_model,
        chunk_windows_,
        chunk_sentences_,
        chunk_documents_,
        hash_embed_,
        embed_batches,
        embed_queries_,
        check_vectors_,
        embed_documents_,
        embed_documents_append,
        content_key,
        dense_id,
        change_rows,
        apply_changes_,
        sync_index,
        index_stats,
        index_cells,
        vector_topk_cosine,
        vector_topk_l2,
        vector_topk_dot,
        vector_topk_ivf,
        vector_topk_ivf_all_cells,
        vector_topk_ivf_bounded,
        vector_topk_ivf_label_cells,
        ivf_recall,
        search_columns,
        keyword_topk_,
        keyword_topk_stored,
        keyword_top1_truncated,
        rerank_overlap_,
        rerank_model,
        batch_retrieve_,
        two_hop_lookup_,
        stuff_context_,
        build_prompt_,
        generate_,
        extractive_answer_,
        rag_answer,
        chain_pipe,
        chain_map,
        chain_assign,
        eval_dataset_,
        eval_similarity,
        eval_token_f1,
        eval_relevance,
        eval_judged,
        eval_rows,
        eval_summary,
        eval_by_group,
        count_by_location,
        count_rows_,
        chart_top_groups_,
    )
}
