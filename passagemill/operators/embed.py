"""Text to vectors, by a model provider or by the built-in hashing embedder."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from passagemill.functions.text import terms
from passagemill.functions.vectors import vector_fault
from passagemill.session import stage

REQUEST_TEXTS = 150
HASH_DIM = 256
#: Vectors are counted for runs of rows with at most so many cells, and terms (or one row).
RUN_CELLS = 262_144
RUN_TERMS = 500_000


def _term_lists_to_unit_vectors(dim: int):
    """Arrow function: lists of terms to float32 vectors of unit length.

    Each distinct term of a batch is hashed once; the counting is array arithmetic on runs of rows
    of bounded size.
    """

    def run_vectors(term_lists: pa.Array) -> np.ndarray:
        lengths = np.asarray(term_lists.value_lengths().fill_null(0))
        rows = np.repeat(np.arange(len(term_lists)), lengths)
        coded = term_lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        buckets = np.array(
            [int(md5(word.encode()).hexdigest()[:8], 16) % dim for word in words], dtype=np.int64
        )
        cells = rows * dim + buckets[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(cells, minlength=len(term_lists) * dim)
        counts = counts.reshape(len(term_lists), dim).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1))
        norms[norms == 0] = 1.0
        return (counts / norms[:, None]).astype(np.float32)

    def unit_vectors(term_lists: pa.Array) -> pa.Array:
        lengths = np.asarray(term_lists.value_lengths().fill_null(0))
        ends = np.cumsum(lengths, dtype=np.int64)
        values = np.empty(len(term_lists) * dim, dtype=np.float32)
        begin = 0
        while begin < len(term_lists):
            most = ends[begin] - lengths[begin] + RUN_TERMS
            stop = min(begin + max(1, RUN_CELLS // dim), int(np.searchsorted(ends, most, "right")))
            stop = max(stop, begin + 1)
            part = term_lists.slice(begin, stop - begin)
            values[begin * dim : stop * dim] = run_vectors(part).ravel()
            begin = stop
        offsets = pa.array(np.arange(0, (len(term_lists) + 1) * dim, dim, dtype=np.int32))
        mask = term_lists.is_null() if term_lists.null_count else None
        return pa.ListArray.from_arrays(offsets, pa.array(values), mask=mask)

    return unit_vectors


def run_once(function, return_type):
    """An Arrow function that the optimizer neither repeats nor moves.

    From an explode of its result, for one, it would infer a filter that calls it a second time.
    """
    return F.arrow_udf(function, return_type).asNondeterministic()


def hash_vector(text: Column, dim: int = HASH_DIM) -> Column:
    """Unit vector of term counts by hash bucket; all zero for a text without terms.

    The JVM finds the terms. Counting them into a dense vector is the one step without a
    row-local native form, so it is a vectorised Arrow function over whole batches.
    """
    return run_once(_term_lists_to_unit_vectors(dim), ArrayType(FloatType()))(terms(text))


def hash_embed(
    df: DataFrame, text: str = "content", dim: int = HASH_DIM, out: str = "embedding"
) -> DataFrame:
    return df.withColumn(out, hash_vector(F.col(text), dim))


def embed(
    df: DataFrame,
    provider,
    text: str = "content",
    batch: int = REQUEST_TEXTS,
    out: str = "embedding",
    on_error: str = "fail",
) -> DataFrame:
    """Vectors from a model provider, at most ``batch`` texts per request, in row order.

    ``provider.make()`` runs once per Python worker and returns ``predict(texts) -> vectors``.
    With ``on_error="null"`` a failing request yields null vectors and the message in ``error``.
    Model calls cost money: ``stage`` the result before using it more than once.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    vectors = ArrayType(FloatType())
    if on_error == "fail":
        call = predict_batch_udf(
            _requests(provider, None), return_type=vectors, batch_size=batch
        ).asNondeterministic()
        return df.withColumn(out, call(F.col(text)))
    row = StructType([StructField(out, vectors), StructField("error", StringType())])
    call = predict_batch_udf(
        _requests(provider, out), return_type=row, batch_size=batch
    ).asNondeterministic()
    # Batch predictions cannot hold nulls, so an empty error marks success until here.
    good = F.col("_reply.error") == ""
    return df.withColumn("_reply", call(F.col(text))).select(
        *df.columns,
        F.when(good, F.col(f"_reply.{out}")).alias(out),
        F.when(~good, F.col("_reply.error")).alias("error"),
    )


@dataclass(frozen=True)
class HashEmbedder:
    """The built-in embedder, as the plans take one: a name, a width, and a way to add vectors."""

    dim: int = HASH_DIM
    name: str = "hashing"

    def add(self, df: DataFrame, text: str = "content", out: str = "embedding") -> DataFrame:
        return hash_embed(df, text, self.dim, out)


@dataclass(frozen=True)
class ModelEmbedder:
    """A hosted model behind a provider. Vectors are written once, so that no call is repeated."""

    name: str
    dim: int
    provider: object
    batch: int = REQUEST_TEXTS

    def add(self, df: DataFrame, text: str = "content", out: str = "embedding") -> DataFrame:
        return stage(embed(df, self.provider, text, self.batch, out), "vectors")


def _requests(provider, out: str | None):
    def make():
        predict = provider.make()

        def strict(texts: np.ndarray) -> np.ndarray:
            return np.asarray(predict(list(texts)), dtype=np.float32)

        def tolerant(texts: np.ndarray) -> list[dict]:
            try:
                vectors = np.asarray(predict(list(texts)), dtype=np.float32)
                return [{out: vector, "error": ""} for vector in vectors]
            except Exception as failure:
                nothing = np.empty(0, dtype=np.float32)
                return [{out: nothing, "error": str(failure) or "failed"} for _ in texts]

        return strict if out is None else tolerant

    return make


def check_vectors(
    df: DataFrame, dim: int, vector: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """Rows that can be indexed, and the others with the reason in ``fault``."""
    marked = df.withColumn("fault", vector_fault(F.col(vector), dim))
    return (
        marked.where(F.col("fault").isNull()).drop("fault"),
        marked.where(F.col("fault").isNotNull()),
    )


def same_embedder(index: tuple[str, int], query: tuple[str, int]) -> None:
    """Questions must be embedded like the chunks: same model name, same width."""
    if tuple(index) != tuple(query):
        raise ValueError(f"index holds vectors of {index}, the question uses {query}")

