"""Token counts by a two-tier lookup on the map side.

A first pass finds the pre-tokens that are frequent in the table; their token counts become a compact
hash table (sorted 64-bit hashes and one byte each) that every task gets. The second pass cuts each
text into pre-tokens and sums their counts: from the table, from the worker's cache, or from the
tokenizer. Pre-tokens are never shuffled; only each task's most frequent ones leave it. The table
decides the speed alone: any table gives the same counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.common import drop_cache, text_list, utf8_bytes, worker_cache
from passagemill.llm.tokenizing import (
    CACHED_CHARS,
    PieceCache,
    batches_of,
    open_tokenizer,
    segments,
)

TOKENIZER = "byte_bpe_50k.json"

#: Entries of the broadcast table, and how many of them one task may propose.
TABLE_ENTRIES = 65_536
TASK_ENTRIES = 2_048

#: A task's counter is cut back to its most frequent half beyond this size.
COUNTER_ENTRIES = 200_000

#: Signs whose class is the same in every version of the character tables: Latin letters and digits,
#: common punctuation and currency. Texts with any other sign go to the tokenizer as a whole.
_KNOWN = [
    chr(code)
    for code in (9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F))
    if code != 0xAD
]


def _class(*kinds: str) -> str:
    return "".join(re.escape(sign) for sign in _KNOWN if unicodedata.category(sign)[0] in kinds)


_LETTERS, _NUMBERS = _class("L"), _class("N")
_UNKNOWN = re.compile(f"[^{''.join(map(re.escape, _KNOWN))}]")
_BLANK = " \t\n\r"
_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANK}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
#: What starts a special token's string; such texts go to the tokenizer as a whole.
_SPECIAL = "<|"


def pre_tokens(text: str) -> list[list[str]] | None:
    """The pre-tokens of each segment, or None if the text needs the tokenizer itself."""
    if _SPECIAL in text or _UNKNOWN.search(text):
        return None
    return [_PIECES.findall(part) for part in segments(text)]


def _digests(pieces: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(piece.encode()) for piece in pieces), np.uint64, len(pieces))


def frequent_pieces(
    documents: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES
) -> DataFrame:
    """The most frequent pre-tokens over all texts, as each task counts them: ``piece, times``.

    Each task proposes at most ``TASK_ENTRIES`` of its own. The choice bounds the table, not the
    texts: all of them are counted.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            for value in text_list(batch.column(0)):
                for part in pre_tokens(value) or ():
                    counter.update(part)
                if len(counter) > COUNTER_ENTRIES:
                    counter = Counter(dict(counter.most_common(COUNTER_ENTRIES // 2)))
        top = [one for one in counter.most_common(TASK_ENTRIES) if len(one[0]) <= CACHED_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["piece", "times"],
        )

    found = documents.select(text).mapInArrow(heads, "piece string, times long")
    return (
        found.groupBy("piece")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "piece")
        .limit(entries)
    )


def length_table(pieces: list[str], tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the pieces and how many tokens each has (up to 255)."""
    encoded = open_tokenizer(tokenizer).encode_batch_fast(pieces, add_special_tokens=False)
    lengths = np.array([len(one.ids) for one in encoded], dtype=np.int64)
    digests = _digests(pieces)
    digests, first = np.unique(digests, return_index=True)
    lengths = lengths[first]
    small = lengths <= 255
    return digests[small], lengths[small].astype(np.uint8)


def count_tokens(
    documents: DataFrame,
    text: str = "text",
    tokenizer: str = TOKENIZER,
    output: str = "n_tokens",
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """Add ``output``: the number of tokens of the whole text, as the tokenizer's library gives it.

    No begin, end or added special tokens are counted; a special token's string inside a text is one
    token, the library's default. Null and empty text have 0 tokens. Repeated rows are counted each;
    an empty table gives an empty table; other columns pass unchanged, one already called ``output``
    is replaced.
    """
    spark = documents.sparkSession
    frequent = [row["piece"] for row in frequent_pieces(documents, text, entries).collect()]
    shared = spark.sparkContext.broadcast(length_table(frequent, tokenizer))

    def encode(pieces: list[str]) -> list[int]:
        keys, lengths = shared.value
        counts = np.zeros(len(pieces), dtype=np.int64)
        if len(pieces) and len(keys):
            digests = _digests(pieces)
            at = np.minimum(np.searchsorted(keys, digests), len(keys) - 1)
            counts = np.where(keys[at] == digests, lengths[at].astype(np.int64), 0)
        rest = np.flatnonzero(counts == 0)
        if len(rest):
            found = open_tokenizer(tokenizer).encode_batch_fast(
                [pieces[at] for at in rest], add_special_tokens=False
            )
            counts[rest] = [len(one.ids) for one in found]
        return counts.tolist()

    def counted(texts: list[str]) -> Iterator[int]:
        cache = worker_cache("token_counts", tokenizer).setdefault("pieces", PieceCache())
        for begin, end in batches_of(texts):
            cut = [pre_tokens(value) for value in texts[begin:end]]
            pieces = set().union(*(part for parts in cut if parts for part in parts))
            cache.fill(pieces, encode)
            for value, parts in zip(texts[begin:end], cut, strict=True):
                if parts is None:
                    whole = open_tokenizer(tokenizer)
                    yield len(whole.encode(value, add_special_tokens=False).ids)
                else:
                    yield sum(sum(map(cache.__getitem__, part)) for part in parts)

    @F.pandas_udf("long")
    def n_tokens(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            yield pd.Series(list(counted([value or "" for value in column])), dtype="int64")
        # Spark takes its idle workers in turn: each of them would keep a cache
        drop_cache()

    return documents.withColumn(output, n_tokens(F.col(text)))


def over_limit(count: Column, limit: int) -> Column:
    return count > limit


def token_report(documents: DataFrame, limit: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether it has more tokens than ``limit``."""
    rows = documents.select("doc_id", "text", utf8_bytes(F.col("text")).alias("n_bytes"))
    counted = count_tokens(rows, tokenizer=tokenizer)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", over_limit(F.col("n_tokens"), limit).alias("over_limit")
    )
