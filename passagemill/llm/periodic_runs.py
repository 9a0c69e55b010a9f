"""Stretches of words that repeat with a period, and texts with the repetitions taken out.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST_LENGTH`` words and
``LEAST_TIMES`` periods long, that no neighbouring word carries on. Each of its words occurs in it at least
``LEAST_TIMES`` times. A word that is rarer than that in its segment of the text therefore lies in no run
and splits the segment, which makes other words rare in the parts; this is repeated until no segment
changes. In most prose nothing is left.

What is left is scanned for lags, an octave at a time. In a run with period q, every window of K >= q words
occurs next exactly q words later, and every stretch of places whose windows do so is a run. So for K = 1,
2, 4, ... the lag of a place is the distance to its next equal window, and runs with periods above K / 2 and
up to K are the stretches of places with one such lag. Windows that occur once are dropped, and those of
2K words are pairs of windows of K words, so a segment of m words costs m log(m) steps for each octave in
which windows still repeat, and not a step for each pair of word and period.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from passagemill.llm.common import let, words_column

#: A run has so many words, and so many periods, at least.
LEAST_LENGTH = 6
LEAST_TIMES = 4
#: Segments that still change after so many rounds are scanned as they are: rare words in them cost time
#: and change no result. Prose needs two or three rounds.
ROUNDS = 64
#: A result is handed on when the texts in it have so many bytes.
BATCH_BYTES = 8_000_000


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers in a rising list."""
    breaks = np.flatnonzero(np.diff(places) != 1)
    return places[np.r_[0, breaks + 1]], places[np.r_[breaks, len(places) - 1]]


def split_by_frequency(codes: np.ndarray) -> np.ndarray:
    """The places that lie in a surviving segment: no word of one is rare in it, none is short.

    ``codes`` numbers the words of a text from 0. Segments are told apart by the gaps between them.
    """
    kept = np.arange(len(codes))
    done: list[np.ndarray] = []
    for number in range(ROUNDS):
        if len(kept) < LEAST_LENGTH:
            break
        segment = np.cumsum(np.r_[0, np.diff(kept) != 1])
        lengths = np.bincount(segment)
        if number == 0:
            counts = np.bincount(codes)[codes]
        else:
            pair = segment * (int(codes.max()) + 1) + codes[kept]
            _, inverse, times = np.unique(pair, return_inverse=True, return_counts=True)
            counts = times[inverse]
        common = counts >= LEAST_TIMES
        # a segment in which nothing is rare stays as it is; the others are looked at again
        whole = np.bincount(segment, weights=~common) == 0
        settled = whole[segment] & (lengths >= LEAST_LENGTH)[segment]
        done.append(kept[settled])
        kept = kept[common & ~whole[segment]]
        if len(kept):
            first, last = _stretches(kept)
            long = last - first + 1 >= LEAST_LENGTH
            kept = kept[np.repeat(long, last - first + 1)]
    return np.sort(np.concatenate([*done, kept])) if done else kept


def lag_scan(codes: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs among the given places, by start and period."""
    runs: list[tuple[int, int, int]] = []
    window = 1
    rank = np.full(len(codes), -1, dtype=np.int64)
    rank[places] = codes[places]
    while len(places):
        order = places[np.argsort(rank[places], kind="stable")]
        same = rank[order[1:]] == rank[order[:-1]]
        lag = np.zeros(len(codes), dtype=np.int64)
        lag[order[:-1][same]] = np.diff(order)[same]
        scanned = lag[places]
        octave = places[(scanned > window // 2) & (scanned <= window)]
        if len(octave):
            breaks = np.flatnonzero((np.diff(octave) != 1) | (np.diff(lag[octave]) != 0))
            first, last = octave[np.r_[0, breaks + 1]], octave[np.r_[breaks, len(octave) - 1]]
            period = lag[first]
            length = last - first + window + period
            good = length >= np.maximum(LEAST_LENGTH, LEAST_TIMES * period)
            runs += zip(first[good].tolist(), length[good].tolist(), period[good].tolist())
        # windows of twice the size, where both halves occur more than once
        left = places[: np.searchsorted(places, len(codes) - window)]
        left = left[rank[left + window] >= 0]
        if not len(left):
            break
        pair = rank[left] * (int(rank.max()) + 1) + rank[left + window]
        _, inverse, times = np.unique(pair, return_inverse=True, return_counts=True)
        rank[:] = -1
        often = times[inverse] > 1
        places = left[often]
        rank[places] = inverse[often]
        window *= 2
    return sorted(runs, key=lambda run: (run[0], run[2]))


def word_codes(words: list[bytes]) -> np.ndarray:
    """The words as numbers from 0, equal ones alike."""
    numbers = {word: at for at, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    if len(words) < LEAST_LENGTH:
        return []
    codes = word_codes(words)
    return lag_scan(codes, split_by_frequency(codes))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains behind its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([words[at] for at in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


def find_runs(
    documents: DataFrame, text: Column | str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``row, n_words, runs, collapsed``: each row as a struct, its runs by start and period, and its text
    without them. ``keep`` names the columns of the struct, all if not given.

    Words are separated by blanks (``common.BLANKS``) and compared byte by byte. A null text is empty: no
    words, no runs, an empty collapsed text. Repeated rows are rows of their own; columns of any names,
    null or not, stay inside ``row``, and an empty table gives an empty one. Each text is worked on by
    itself in one task, in memory that grows with its own length only; nothing is shuffled.
    """
    value = F.col(text) if isinstance(text, str) else text
    given = documents.select(
        F.struct(*(documents.columns if keep is None else keep)).alias("row"),
        F.coalesce(value, F.lit("")).alias("_text"),
    )
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType(
        [
            given.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            found: list[tuple] = []
            begin = held = 0
            for at in range(len(texts)):
                words = texts[at].as_py().encode().split()
                runs = runs_of(words)
                found.append((len(words), runs, collapsed(words, runs)))
                held += len(found[-1][2])
                if held >= BATCH_BYTES or at + 1 == len(texts):
                    yield _batch(rows.slice(begin, at + 1 - begin), found, arrow)
                    found, begin, held = [], at + 1, 0

    return given.mapInArrow(find, schema)


def _batch(rows: pa.Array, found: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    numbers, runs, texts = zip(*found)
    triples = np.array([run for one in runs for run in one], dtype=np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    fields = [pa.array(np.ascontiguousarray(triples[:, at])) for at in range(3)]
    records = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    columns = [
        rows,
        pa.array(numbers, pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), records),
        pa.array(texts, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(
        [column.cast(field.type) for column, field in zip(columns, arrow)], schema=arrow
    )


def longest_run(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null if there is none."""
    ranked = F.transform(
        runs,
        lambda run: F.struct(
            run["length"].alias("length"), (-run["start"]).alias("back"), (-run["period"]).alias("short")
        ),
    )
    return F.array_max(ranked)


def runs_digest(runs: Column) -> Column:
    """SHA-256 of the lines ``start,length,period`` of all runs, each with its line end."""
    lines = F.transform(
        runs, lambda run: F.concat_ws(",", *[run[name].cast("string") for name in ("start", "length", "period")])
    )
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return F.sha2(text.cast("binary"), 256)


def with_repetition(text: Column, key: Column) -> Column:
    """One text in ten, by its key's checksum, with its words from some place on repeating its next words.

    With ``h`` the CRC-32 of the key's decimal text and ``g = h // 10``, a text of n > 0 words is changed if
    h is divisible by ten: from word ``a = g % n`` on it repeats the ``1 + (n - a) // (3 + g % 8)`` words that
    begin there. The words are then joined by one space. A null key changes nothing.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        return let(
            F.struct(words.alias("words"), n.alias("n"), F.pmod(g, n).cast("int").alias("a")),
            lambda at: F.array_join(
                F.concat(
                    F.slice(at["words"], 1, at["a"]),
                    F.slice(_block(at["words"], at["n"] - at["a"], at["a"], g), 1, at["n"] - at["a"]),
                ),
                " ",
            ),
        )

    def changed(words: Column) -> Column:
        return F.when(F.size(words) > 0, repeated(words)).otherwise(F.lit(""))

    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), let(words_column(text), changed)).otherwise(text)


def _block(words: Column, left: Column, begin: Column, g: Column) -> Column:
    """The period's words, often enough to fill the rest of the text."""
    period = (1 + F.floor(left / (3 + g % 8))).cast("int")
    times = F.ceil(left / period).cast("int")
    return F.flatten(F.array_repeat(F.slice(words, begin + 1, period), times))
