"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import math
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blanks between words: space and the control characters from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"

#: ASCII lower case; other letters stay as they are.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once.

    A column named inside a lambda is computed again for each element; a lambda's variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_column(text: Column) -> Column:
    """The words of ``text``: runs of other signs than blanks. Null and empty text: no words."""
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), BLANKS), lambda word: word != F.lit("")
    )


def id_crc32(key: Column) -> Column:
    """CRC-32 of the key's decimal text, 0 for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0).cast("long"))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over all tasks that it runs.

    Functions travel to the workers by value, so a global of this module would start anew with
    each task.
    """
    holder = sys.modules.setdefault("passagemill_worker", types.ModuleType("passagemill_worker"))
    return holder.__dict__.setdefault("states", {}).setdefault(name, {})


def worker_cache(name: str, key) -> dict:
    """The worker's cache of this name for ``key``. A worker has one cache at a time: the first task that
    asks for another gives the memory of the last one back."""
    held = worker_state("cache")
    if (name, key) not in held:
        held.clear()
        release_memory()
        held[name, key] = {}
    return held[name, key]


def drop_cache() -> None:
    """Give the memory of the worker's cache back, before work that has none."""
    held = worker_state("cache")
    if held:
        held.clear()
        release_memory()


def release_memory() -> None:
    """Hand memory that is no longer used back to the system, where the C library can do so."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_list(column: pa.Array) -> list[str]:
    """The strings of an Arrow column, null as empty."""
    return [value or "" for value in column.to_pylist()]


def greatest_label(labelled: DataFrame, column: str) -> DataFrame:
    """One row per key; of several labels the greatest counts. Rows without key are left out."""
    return labelled.where("doc_id is not null").groupBy("doc_id").agg(F.max(column).alias(column))


def texts_of(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """``doc_id, text`` and the columns of ``chosen``, one row per key; of several texts the greatest counts.

    The chosen rows are few by construction, so they are broadcast: of the documents only theirs are
    shuffled, and each task adds up its own first.
    """
    found = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    others = [name for name in chosen.columns if name != "doc_id"]
    return found.groupBy("doc_id", *others).agg(F.max("text").alias("text")).select("doc_id", "text", *others)


def labelled_sample(documents: DataFrame, labelled: DataFrame, column: str, limit: int) -> DataFrame:
    """``doc_id, text`` and the label of about ``limit`` labelled documents at most, chosen by a hash."""
    marked = greatest_label(labelled, column)
    scale = 1 << 20
    share = math.floor(scale * min(1.0, limit / max(marked.count(), 1)))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)
    return texts_of(documents, chosen)
