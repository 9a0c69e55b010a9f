"""Language-model scores from an interpolated three-word model in memory-mapped tries.

Training counts words, then pairs and triples of word numbers. Tasks add up the n-grams of their
batches before the shuffle and deal them by a hash of the first two words, so that no word gathers in
one task. Each shard becomes one trie file in the shared folder. Scoring is one pass over the texts:
every task maps the files and reads the pages that its n-grams touch.

A token's probability is the discounted share of its triple, plus the weight that is left times that
of its pair, and so on down to the smoothed share of the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.mapped_files import load_arrays, save_arrays, shared_folder
from passagemill.llm.ngram_trie import Trie, build_trie, encode_scale
from passagemill.llm.word_hashes import mix, row_blocks, word_hashes
from passagemill.session import stage

#: Training tokens per trie, which bounds the memory of the task that builds it.
SHARD_TOKENS = 2_500_000

#: Tokens whose n-grams a task adds up before it hands them on.
BATCH_TOKENS = 1_200_000

#: Bytes of text scored at once.
SCORE_BYTES = 3 << 20

#: The hash of the end of a text; words have hashes of their own.
END = np.int64(0x0E9D_C0DE_5EED_7E47)


class Pieces(NamedTuple):
    """A sorted table in files: the first key, the number of keys before, and the file of each."""

    first: np.ndarray
    before: np.ndarray
    files: list[str]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and value of each of the sorted keys; -1 and 0 if it is not there."""
        numbers = np.full(len(keys), -1, dtype=np.int64)
        values = np.zeros(len(keys), dtype=np.int64)
        bounds = np.append(np.searchsorted(keys, self.first), len(keys))
        for at, name in enumerate(self.files):
            low, high = bounds[at], bounds[at + 1]
            if low < high:
                arrays, _ = load_arrays(name)
                held, wanted = arrays["keys"], keys[low:high]
                place = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                there = held[place] == wanted
                numbers[low:high] = np.where(there, place + self.before[at], -1)
                values[low:high] = np.where(there, arrays["values"][place], 0)
        return numbers, values


def write_pieces(rows: DataFrame, folder: str, name: str, scaled: bool = False) -> tuple[Pieces, dict]:
    """Write ``key long, value`` as sorted pieces, one per range of keys.

    With ``scaled``, values are positive numbers kept as one byte each. Returns the pieces and the
    sums of rows and values. Only one row per piece comes to the driver.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            keys, values = (table.column(at).to_numpy() for at in (0, 1))
            arrays = {"keys": keys, "values": values}
            if scaled:
                codes, scale = encode_scale(values)
                arrays = {"keys": keys, "values": codes, "scale": scale}
            file = save_arrays(folder, name, arrays)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[0]]), pa.array([len(keys)]), pa.array([float(values.sum())]), pa.array([file])],
                ["first", "count", "total", "file"],
            )

    schema = "first long, count long, total double, file string"
    sorted_rows = rows.repartitionByRange("key").sortWithinPartitions("key")
    manifest = stage(sorted_rows.mapInArrow(written, schema), f"lm-{name}")
    found = sorted(manifest.collect(), key=lambda row: row["first"])
    counts = np.array([row["count"] for row in found], dtype=np.int64)
    pieces = Pieces(
        np.array([row["first"] for row in found], dtype=np.int64),
        np.cumsum(counts) - counts,
        [row["file"] for row in found],
    )
    return pieces, {"count": int(counts.sum()), "total": int(sum(row["total"] for row in found))}


def count_words(documents: DataFrame) -> DataFrame:
    """``key, value``: hash and count of each word, and of the end of texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        ends = size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.bincount(inverse, weights=np.concatenate([c for _, c in held]))
            return keys, sums.astype(np.int64)

        for batch in batches:
            column = batch.column(0)
            ends += len(column)
            for low, high in row_blocks(column):
                hashes = word_hashes(column.slice(low, high - low)).hashes.view(np.int64)
                held.append(np.unique(hashes, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * BATCH_TOKENS:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > BATCH_TOKENS:
                        yield pa.RecordBatch.from_arrays([pa.array(a) for a in held.pop()], ["key", "value"])
                        size = 0
        held.append((np.array([END]), np.array([ends])))
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in merged()], ["key", "value"])

    rows = documents.select("text").mapInArrow(counted, "key long, value long")
    return rows.groupBy("key").agg(F.sum("value").alias("value"))


class Tokens(NamedTuple):
    """Word numbers of some texts in order, with what the unigram level knows of them."""

    numbers: np.ndarray
    counts: np.ndarray
    first: np.ndarray


class NgramModel(NamedTuple):
    """Files and totals of a trained model.

    Words have the numbers 0 to ``words`` - 1 in the order of their hashes; ``words`` stands for any
    unknown word and ``words`` + 1 for the beginning of a text.
    """

    vocabulary: Pieces
    contexts: Pieces
    tries: list[str]
    words: int
    tokens: int
    texts: int

    @property
    def unknown(self) -> int:
        return self.words

    @property
    def begin(self) -> int:
        return self.words + 1

    def numbered(self, column: pa.Array) -> Tokens:
        """The tokens of a text column: its words, then one end per text."""
        found = word_hashes(column)
        sizes = np.diff(found.first)
        first = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
        hashes = np.full(first[-1], END, dtype=np.int64)
        inner = np.ones(first[-1], dtype=bool)
        inner[first[1:] - 1] = False
        hashes[inner] = found.hashes.view(np.int64)
        keys, inverse = np.unique(hashes, return_inverse=True)
        numbers, counts = self.vocabulary.find(keys)
        numbers = np.where(numbers < 0, self.unknown, numbers)
        return Tokens(numbers[inverse], counts[inverse], first)

    def pair_keys(self, tokens: Tokens) -> np.ndarray:
        """Each token with the one before it (or the beginning), as one number."""
        before = np.concatenate([[self.begin], tokens.numbers[:-1]])
        before[tokens.first[:-1]] = self.begin
        return before.astype(np.uint64) * np.uint64(self.words + 2) + tokens.numbers.astype(np.uint64)

    def shard_of(self, pairs: np.ndarray, shards: int) -> np.ndarray:
        return (mix(pairs) % np.uint64(shards)).astype(np.int64)

    def first_count(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often a word begins a pair: each time that it occurs, and once per text for the
        beginning."""
        return np.where(words == self.begin, self.texts, counts)


def _packed(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers as bytes, sorted by significance and compressed."""
    planes = values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, count: int, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, count * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind).reshape(-1)


def count_ngrams(documents: DataFrame, model: NgramModel, shards: int) -> DataFrame:
    """Pairs and triples of the training texts, added up per batch and packed per shard.

    A row holds a shard's sorted pairs of one batch, their counts, how many triples each begins, and
    those triples' last words and counts.
    """
    names = ["shard", "n_pairs", "n_triples", "pairs", "counts", "children", "third", "third_counts"]

    def packed(tokens: list[Tokens]) -> pa.RecordBatch:
        keys = np.concatenate([model.pair_keys(one) for one in tokens])
        last = np.zeros(len(keys), dtype=bool)
        at = 0
        for one in tokens:
            last[at + one.first[1:] - 1] = True
            at += len(one.numbers)
        numbers = np.concatenate([one.numbers for one in tokens])
        pairs, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        begins = np.flatnonzero(~last)
        triples = (inverse[begins].astype(np.uint64) << np.uint64(32)) | numbers[begins + 1].astype(np.uint64)
        triples, third_counts = np.unique(triples, return_counts=True)
        context = (triples >> np.uint64(32)).astype(np.int64)
        third = triples & np.uint64(0xFFFFFFFF)
        children = np.bincount(context, minlength=len(pairs))
        shard = model.shard_of(pairs, shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        triple_shard = shard[context]
        triple_order = np.argsort(triple_shard, kind="stable")
        triple_bounds = np.searchsorted(triple_shard[triple_order], np.arange(shards + 1))
        rows: list[list] = [[] for _ in names]
        for one in range(shards):
            own = order[bounds[one] : bounds[one + 1]]
            sub = triple_order[triple_bounds[one] : triple_bounds[one + 1]]
            if len(own):
                steps = np.diff(pairs[own], prepend=np.uint64(0))
                row = [
                    one,
                    len(own),
                    len(sub),
                    _packed(steps, "<u8"),
                    _packed(counts[own]),
                    _packed(children[own]),
                    _packed(third[sub]),
                    _packed(third_counts[sub]),
                ]
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Tokens] = []
        size = 0
        for batch in batches:
            column = batch.column(0)
            for low, high in row_blocks(column):
                held.append(model.numbered(column.slice(low, high - low)))
                size += len(held[-1].numbers)
                if size >= BATCH_TOKENS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    schema = (
        "shard int, n_pairs long, n_triples long, pairs binary, counts binary, children binary, "
        "third binary, third_counts binary"
    )
    return documents.select("text").mapInArrow(counted, schema)


def build_tries(ngrams: DataFrame, model: NgramModel, shards: int, folder: str) -> DataFrame:
    """One trie file per shard: ``file, words, masses`` (what discounting took, per first word)."""
    base = model.words + 2

    def merged(rows: list[dict]) -> tuple[str, np.ndarray, np.ndarray]:
        keys, counts, context, third, third_counts = [], [], [], [], []
        at = 0
        for row in rows:
            n, m = row["n_pairs"], row["n_triples"]
            keys.append(np.cumsum(_unpacked(row["pairs"], n, "<u8"), dtype=np.uint64))
            counts.append(_unpacked(row["counts"], n))
            context.append(np.repeat(np.arange(at, at + n), _unpacked(row["children"], n)))
            third.append(_unpacked(row["third"], m))
            third_counts.append(_unpacked(row["third_counts"], m))
            at += n
        pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
        triples = inverse[np.concatenate(context)].astype(np.uint64) << np.uint64(32)
        triples, inverse = np.unique(triples | np.concatenate(third), return_inverse=True)
        third_total = np.bincount(inverse, weights=np.concatenate(third_counts)).astype(np.int64)
        first = (pairs // np.uint64(base)).astype(np.int64)
        words, places = np.unique(first, return_inverse=True)
        first_counts = model.first_count(words, first_counts_of(words))[places]
        arrays, roots, masses = build_trie(
            first,
            (pairs % np.uint64(base)).astype(np.int64),
            total,
            first_counts,
            (triples >> np.uint64(32)).astype(np.int64),
            (triples & np.uint64(0xFFFFFFFF)).astype(np.int64),
            third_total,
            base - 1,
        )
        return save_arrays(folder, f"trie-{rows[0]['shard']}", arrays), roots, masses

    def first_counts_of(words: np.ndarray) -> np.ndarray:
        """Training counts of sorted word numbers, from the vocabulary's files."""
        counts = np.zeros(len(words), dtype=np.int64)
        vocabulary = model.vocabulary
        bounds = np.append(np.searchsorted(words, vocabulary.before), len(words))
        for at, name in enumerate(vocabulary.files):
            low, high = bounds[at], bounds[at + 1]
            values = load_arrays(name)[0]["values"]
            own = words[low:high] - vocabulary.before[at]
            inside = own < len(values)
            counts[low:high][inside] = values[own[inside]]
        return counts

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def out() -> pa.RecordBatch:
            file, words, masses = merged(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held[0]["shard"]], pa.int32()),
                    pa.array([file]),
                    pa.array([words.tolist()], pa.list_(pa.int64())),
                    pa.array([masses.tolist()], pa.list_(pa.float64())),
                ],
                ["shard", "file", "words", "masses"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["shard"] != row["shard"]:
                    yield out()
                    held.clear()
                held.append(row)
        if held:
            yield out()

    schema = "shard int, file string, words array<long>, masses array<double>"
    return ngrams.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(built, schema)


def fit_ngram_model(documents: DataFrame, shard_tokens: int = SHARD_TOKENS) -> NgramModel:
    """Train on the ``text`` of all rows; null is empty. Without rows, every token is unknown.

    Words have to be fewer than 2**32. The driver keeps file names and totals only.
    """
    spark = documents.sparkSession
    folder = shared_folder(spark, "language-model")
    vocabulary, sums = write_pieces(count_words(documents), folder, "words")
    none = Pieces(np.zeros(0, np.int64), np.zeros(0, np.int64), [])
    texts = 0
    if sums["count"]:
        texts = int(vocabulary.find(np.array([END]))[1][0])
    model = NgramModel(vocabulary, none, [], sums["count"], sums["total"], texts)
    if not sums["count"]:
        return model
    shards = max(1, -(-model.tokens // shard_tokens))
    built = stage(build_tries(count_ngrams(documents, model, shards), model, shards, folder), "lm-tries")
    files = {row["shard"]: row["file"] for row in built.select("shard", "file").collect()}
    taken = (
        built.select(F.explode(F.arrays_zip("words", "masses")).alias("one"))
        .groupBy(F.col("one.words").alias("key"))
        .agg(F.sum("one.masses").alias("value"))
    )
    contexts, _ = write_pieces(taken, folder, "contexts", scaled=True)
    return model._replace(contexts=contexts, tries=[files.get(one, "") for one in range(shards)])


def _context_weights(model: NgramModel, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The weight left to single words after each of some word numbers; 1 after unknown ones."""
    keys, inverse = np.unique(words, return_inverse=True)
    found = np.zeros(len(keys))
    pieces = model.contexts
    bounds = np.append(np.searchsorted(keys, pieces.first), len(keys))
    for at, name in enumerate(pieces.files):
        low, high = bounds[at], bounds[at + 1]
        if low < high:
            arrays, _ = load_arrays(name)
            place = np.minimum(np.searchsorted(arrays["keys"], keys[low:high]), len(arrays["keys"]) - 1)
            there = arrays["keys"][place] == keys[low:high]
            found[low:high] = np.where(there, arrays["scale"][arrays["values"][place]], 0.0)
    masses = found[inverse]
    return np.where(masses > 0, masses / np.maximum(counts, 1), 1.0)


def token_probabilities(model: NgramModel, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed word shares and the model's probabilities of all tokens."""
    single = (tokens.counts + 0.5) / (model.tokens + 0.5 * (model.words + 1))
    if not model.tries or not len(tokens.numbers):
        return single, single.copy()
    base = np.uint64(model.words + 2)
    keys, inverse = np.unique(model.pair_keys(tokens), return_inverse=True)
    shard = model.shard_of(keys, len(model.tries))
    before, word = (keys // base).astype(np.int64), (keys % base).astype(np.int64)
    starts = np.zeros(len(tokens.numbers), dtype=bool)
    starts[tokens.first[:-1]] = True
    later = np.flatnonzero(~starts)
    context = inverse[later - 1]
    triples, triple_of = np.unique(
        (context.astype(np.uint64) << np.uint64(32)) | tokens.numbers[later].astype(np.uint64),
        return_inverse=True,
    )
    triple_context = (triples >> np.uint64(32)).astype(np.int64)
    third = (triples & np.uint64(0xFFFFFFFF)).astype(np.int64)

    pair_value, weight = np.zeros(len(keys)), np.ones(len(keys))
    triple_value = np.zeros(len(triples))
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(len(model.tries) + 1))
    triple_shard = shard[triple_context]
    triple_order = np.argsort(triple_shard, kind="stable")
    triple_bounds = np.searchsorted(triple_shard[triple_order], np.arange(len(model.tries) + 1))
    nodes = np.full(len(keys), -1, dtype=np.int64)
    for one, file in enumerate(model.tries):
        own = order[bounds[one] : bounds[one + 1]]
        if not len(own) or not file:
            continue
        trie = Trie(load_arrays(file)[0])
        nodes[own] = trie.pairs(before[own], word[own])
        pair_value[own] = trie.value("pairs", nodes[own])
        weight[own] = trie.weight(nodes[own])
        sub = triple_order[triple_bounds[one] : triple_bounds[one + 1]]
        sub = sub[nodes[triple_context[sub]] >= 0]
        found = trie.triples(nodes[triple_context[sub]], third[sub])
        triple_value[sub] = trie.value("triples", found)

    counts = np.concatenate([[model.texts], tokens.counts[:-1]])
    counts[starts] = model.texts
    words = np.concatenate([[model.begin], tokens.numbers[:-1]])
    words[starts] = model.begin
    pair = pair_value[inverse] + _context_weights(model, words, counts) * single
    whole = pair.copy()
    whole[later] = triple_value[triple_of] + weight[context] * pair[later]
    return single, np.minimum(whole, 1.0)


def score_documents(documents: DataFrame, model: NgramModel) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: ``doc_id, n_tokens, n_known, base_score, score``.

    Scores are log10 probabilities of the whole text and its end; ``base_score`` is that of its
    words alone. Null and empty texts have one token, the end. Equal texts have equal scores; an
    empty table gives an empty table; other columns are ignored.
    """
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in row_blocks(batch.column(1), SCORE_BYTES):
                part = batch.slice(low, high - low)
                tokens = model.numbered(part.column(1))
                single, whole = token_probabilities(model, tokens)
                starts = tokens.first[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(tokens.first)),
                        pa.array(np.add.reduceat((tokens.counts > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(np.log10(single), starts)),
                        pa.array(np.add.reduceat(np.log10(whole), starts)),
                    ],
                    names,
                )

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return documents.select("doc_id", "text").mapInArrow(scored, schema)
