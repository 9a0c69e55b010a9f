"""Concatenate and cut: all documents' tokens as one stream, cut into fixed windows.

The first pass tokenizes and writes each document's ids with its offset inside its task. The task's
token totals, summed in the order of the tasks, turn that into an offset in the whole stream. The
second pass cuts: a document that crosses window borders becomes one piece per window.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.llm.common import drop_cache, let, worker_cache
from passagemill.llm.tokenizing import PieceCache, packed_ids, split_words
from passagemill.session import arrow_batch_rows, new_path

TOKENIZER = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2

#: Documents that a worker takes at once.
BATCH_ROWS = 1_000

#: Texts are encoded and handed on in runs of about so many bytes.
RUN_BYTES = 1 << 22

#: Entries of each generation of a task's cache of ids.
CACHED_PIECES = 200_000


def encode_texts(texts: pa.Array, tokenizer: str, end_id: int) -> Iterator[pa.Array]:
    """The ids of each text and the end id, as little-endian unsigned 32-bit numbers, run by run.

    The tokenizer must drop white space and never join what blanks separate; then a text's ids are
    those of its words, one after the other. A run's distinct words are looked up once.
    """
    cache = worker_cache("word_ids", tokenizer).setdefault("pieces", PieceCache(CACHED_PIECES))
    end = pa.scalar(struct.pack("<I", end_id), pa.binary())

    def ids_of(pieces: pa.Array) -> pa.Array:
        distinct = pieces.dictionary_encode()
        names = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        cache.fill(names, lambda missing: packed_ids(missing, tokenizer))
        return pa.array(map(cache.__getitem__, names), pa.binary(), size=len(names)).take(distinct.indices)

    def run(texts: pa.Array) -> pa.Array:
        # this splits at the six ASCII blanks only, and leaves empty words at a text's ends
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        stems, signs = (ids_of(pieces) for pieces in split_words(words.dictionary, tokenizer))
        found = pc.binary_join_element_wise(stems, signs, b"").take(words.indices)
        _, offsets, ids = found.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int32)[np.asarray(split.offsets)]
        whole = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), ids])
        return pc.binary_join_element_wise(whole, end, b"")

    texts = texts.fill_null("")
    if len(texts):
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        runs = np.concatenate([[0], ends[:-1]]) // RUN_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)]
        for begin, stop in zip(bounds[:-1], bounds[1:], strict=True):
            yield run(texts.slice(begin, stop - begin))


def token_stream(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> DataFrame:
    """Each document's ids and where they begin in the stream: ``key, ids, n_ids, begin``.

    The ids are written once to the shared folder, so a lost executor costs a reread of them.
    """
    spark = documents.sparkSession
    names = [key, "ids", "n_ids", "part", "local"]

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            begin = 0
            for ids in encode_texts(batch.column(1), tokenizer, end_id):
                sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
                ends = np.cumsum(sizes) + total
                columns = [
                    batch.column(0).slice(begin, len(ids)),
                    ids,
                    pa.array(sizes),
                    pa.array(np.full(len(ids), part, dtype=np.int64)),
                    pa.array(ends - sizes),
                ]
                total, begin = int(ends[-1]), begin + len(ids)
                yield pa.RecordBatch.from_arrays(columns, names)
        # Spark takes its idle workers in turn: each of them would keep a cache
        drop_cache()

    rows = documents.select(F.col(key), F.col(text).alias("text"))
    schema = f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary, n_ids long, part long, local long"
    path = new_path(spark, "token-stream")
    stored = rows.mapInArrow(tokenized, schema)
    # a worker holds a batch's texts
    with arrow_batch_rows(spark, BATCH_ROWS):
        stored.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(stored.schema).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("total"))
    # one row per task of the first pass: some bytes each, so the sums fit one task and a broadcast
    starts = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("start")
    )
    return stored.join(F.broadcast(starts), "part").select(
        key, "ids", "n_ids", (F.col("start") + F.col("local")).alias("begin")
    )


def _pieces(ids: Column, n_ids: Column, begin: Column, window: int) -> Column:
    def cut(bound: Column) -> Column:
        def piece(sequence: Column) -> Column:
            first = F.greatest(sequence * window, bound["begin"])
            last = F.least((sequence + 1) * window, bound["begin"] + bound["n_ids"])
            return F.struct(
                (first - bound["begin"]).alias("start"),
                (last - first).alias("length"),
                F.substring(
                    bound["ids"],
                    ((first - bound["begin"]) * 4 + 1).cast("int"),
                    ((last - first) * 4).cast("int"),
                ).alias("ids"),
                sequence.alias("sequence_id"),
                (first - sequence * window).alias("offset"),
            )

        size = F.lit(window).cast("long")
        low = F.floor(bound["begin"] / size).cast("long")
        high = F.floor((bound["begin"] + bound["n_ids"] - 1) / size).cast("long")
        return F.transform(F.sequence(low, high), piece)

    return let(F.struct(ids.alias("ids"), n_ids.alias("n_ids"), begin.alias("begin")), cut)


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """The pieces of all documents: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit numbers, ``start`` counts the
    document's ids before them, ``offset`` those before them in the sequence. All sequences but the
    last are full. A null or empty text is its end id alone; repeated rows are packed each; an empty
    table has no pieces. Other columns are ignored.
    """
    stream = token_stream(documents, key, text, tokenizer, end_id)
    pieces = F.explode(_pieces(F.col("ids"), F.col("n_ids"), F.col("begin"), window))
    return stream.select(F.col(key), F.col("n_ids").alias("doc_tokens"), pieces.alias("piece")).select(
        key,
        "piece.start",
        "piece.length",
        "piece.ids",
        "doc_tokens",
        "piece.sequence_id",
        "piece.offset",
    )


def sequences(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whole sequences: ``sequence_id, ids, length, boundaries`` (offset and key of each piece)."""
    held = F.array_sort(F.collect_list(F.struct("offset", F.col(key).alias("key"), "ids")))
    return (
        pieces.groupBy("sequence_id")
        .agg(held.alias("held"), F.sum("length").alias("length"))
        .select(
            "sequence_id",
            F.aggregate("held", F.lit(b""), lambda all_, one: F.concat(all_, one["ids"])).alias("ids"),
            "length",
            F.transform(
                "held", lambda one: F.struct(one["offset"].alias("offset"), one["key"].alias("key"))
            ).alias("boundaries"),
        )
    )


def piece_report(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        key,
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
