"""Near duplicates by MinHash bands and odd sketches.

A text's distinct word shingles give ``SAMPLES`` MinHash values. Bands of the first ones are the bucket
keys that find candidates; all of them, folded into a bitmap by parity, are its odd sketch. The XOR of two
odd sketches counts the samples in which two sets differ, which sorts candidates out before the full
sets are compared.

Equal sets become one class first. In each bucket the classes are compared with one leader, then
with another; only buckets that still hold several components are searched pair by pair, and only
across components. So a large group of copies costs a comparison per copy and not per pair, and no
link between different components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.common import drop_cache, release_memory
from passagemill.llm.word_hashes import mix, row_blocks, word_hashes
from passagemill.session import stage

WORDS = 5
SIMILARITY = 80

#: 32 bands of 5: two sets of similarity 0.8 share no band with a chance of 3 in a million.
BANDS = 32
ROWS = 5

#: MinHash values of a set. All are folded into the odd sketch, the first ones are the bands.
SAMPLES = 512

#: Bits of an odd sketch, kept as 64-bit numbers.
SKETCH_BITS = 2048
SKETCH_LONGS = SKETCH_BITS // 64

#: Candidates go to the full comparison if their sketches show no more than this less than the
#: wanted similarity: more than four standard errors of the estimate.
MARGIN = 0.08

#: Rows that a worker takes at once, with their texts.
BATCH_ROWS = 1_000

#: Bits at most of the filter of ids that are read again, and places of an id in it.
FILTER_BITS = 1 << 27
FILTER_PLACES = 4

#: A class is all texts with one set of shingles.
CLASS = ["set_a", "set_b", "n_shingles"]

_BLOCK = 1 << 15
_FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(20)) | np.uint64(1)
_WEIGHTS = mix(np.arange(1, 3, dtype=np.uint64) << np.uint64(33)) | np.uint64(1)


def shingle_hashes(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a text column in order, and the first one of each row.

    A text with fewer words has its whole sequence as its one shingle; without words it has none.
    """
    found = word_hashes(column)
    counts = np.diff(found.first)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    # the word at which each shingle begins, and how many words it has
    rows = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.arange(first[-1]) - first[rows] + found.first[rows]
    width = np.minimum(counts[rows], words)
    weights = mix(np.arange(1, words + 2, dtype=np.uint64) << np.uint64(33)) | np.uint64(1)
    total = width.astype(np.uint64) * weights[-1]
    for step in range(words):
        inside = width > step
        total[inside] += found.hashes[begin[inside] + step] * weights[step]
    return mix(total), first


def distinct_sets(shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's shingles sorted and without repeats."""
    sets = [np.unique(shingles[low:high]) for low, high in zip(first, first[1:])]
    bounds = np.concatenate([[0], np.cumsum([len(one) for one in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else shingles[:0]), bounds


def min_hashes(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima per row, in blocks that stay in the processor's cache."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    minima = np.full((SAMPLES, len(first) - 1), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(shingles), _BLOCK):
        block, own = shingles[low : low + _BLOCK], rows[low : low + _BLOCK]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        held = own[starts]
        for at, factor in enumerate(_FACTORS):
            least = np.minimum.reduceat(block * factor, starts)
            minima[at, held] = np.minimum(minima[at, held], least)
    return minima


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Fold each row's samples into ``SKETCH_BITS`` parities: rows x ``SKETCH_LONGS``."""
    rows = minima.shape[1]
    number = np.arange(1, len(minima) + 1, dtype=np.uint64)[:, None]
    bits = mix(minima + number * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(math.log2(SKETCH_BITS)))
    flat = np.arange(rows)[None, :] * SKETCH_BITS + bits.astype(np.int64)
    odd = np.bincount(flat.ravel(), minlength=rows * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(rows, SKETCH_LONGS)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """Rows x ``BANDS`` bucket keys."""
    places = mix(np.arange(1, ROWS + 1, dtype=np.uint64) << np.uint64(41)) | np.uint64(1)
    grouped = minima[: BANDS * ROWS].reshape(BANDS, ROWS, -1) * places[None, :, None]
    number = np.arange(BANDS, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    return mix(grouped.sum(axis=1, dtype=np.uint64) + number).view(np.int64).T


def differing_bits(similarity: float) -> float:
    """Expected XOR count of the odd sketches of two sets with this similarity."""
    samples = 2 * SAMPLES * (1 - similarity)
    return SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** samples)


def estimated_similarity(differing: Column) -> Column:
    """The similarity that so many differing bits of two odd sketches stand for."""
    share = F.greatest(1 - 2 * differing / F.lit(float(SKETCH_BITS)), F.lit(1e-9))
    return 1 + (SKETCH_BITS / 2) * F.log(share) / F.lit(2.0 * SAMPLES)


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)))


def keyed_rows(documents: DataFrame) -> DataFrame:
    """The rows with ``row_a, row_b``, a 128-bit key of ``doc_id`` and ``text``."""
    return documents.withColumns(
        {"row_a": F.xxhash64("doc_id", "text"), "row_b": F.xxhash64(F.lit("row"), "text", "doc_id")}
    )


def set_digests(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 128-bit digest of each row's distinct shingles, 0 without any: 2 x rows."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    digests = np.zeros((2, len(sizes)), dtype=np.uint64)
    if len(full):
        starts = first[:-1][full]
        digests[0, full] = np.add.reduceat(mix(sets), starts)
        digests[1, full] = np.bitwise_xor.reduceat(mix(sets * _WEIGHTS[0] + _WEIGHTS[1]), starts)
    return digests.view(np.int64)


def signatures(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, row_a, row_b, n_shingles, set_a, set_b, bands, sketch`` of each row; ``set_a, set_b``
    are a 128-bit digest of the whole set."""
    names = ["doc_id", "row_a", "row_b", "n_shingles", "set_a", "set_b", "bands", "sketch"]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_cache()
        for batch in batches:
            for low, high in row_blocks(batch.column(3)):
                part = batch.slice(low, high - low)
                sets, first = distinct_sets(*shingle_hashes(part.column(3), words))
                sizes = np.diff(first)
                full = np.flatnonzero(sizes)
                minima = np.zeros((SAMPLES, len(sizes)), dtype=np.uint64)
                if len(full):
                    minima[:, full] = min_hashes(sets, np.append(first[:-1][full], len(sets)))
                digests = set_digests(sets, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array(sizes),
                        pa.array(digests[0]),
                        pa.array(digests[1]),
                        _lists(band_keys(minima)),
                        _lists(odd_sketches(minima)),
                    ],
                    names,
                )
        release_memory()

    schema = (
        "doc_id long, row_a long, row_b long, n_shingles long, set_a long, set_b long, "
        "bands array<long>, sketch array<long>"
    )
    rows = keyed_rows(documents.select("doc_id", "text"))
    return rows.select("doc_id", "row_a", "row_b", "text").mapInArrow(signed, schema)


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    """The places of each id in a filter of so many bits (a power of two): ids x ``FILTER_PLACES``."""
    number = np.arange(1, FILTER_PLACES + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    return (mix(ids.view(np.uint64)[:, None] + number) & np.uint64(bits - 1)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the one column of ``ids``, as 64-bit words.

    Its size follows the number of ids up to ``FILTER_BITS``, a bound for what is broadcast; beyond
    that it lets more ids pass that are not there, and never holds one back that is.
    """
    bits = 1 << min(max(16 * ids.count(), 1 << 16).bit_length(), FILTER_BITS.bit_length() - 1)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(batch.column(0).to_numpy(zero_copy_only=False), bits).ravel()
            places = np.unique(places)
            word, first = np.unique(places >> 6, return_index=True)
            masks = np.uint64(1) << (places & 63).astype(np.uint64)
            mask = np.bitwise_or.reduceat(masks, first) if len(first) else masks
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(mask.view(np.int64))], ["word", "mask"]
            )

    words = ids.mapInArrow(marked, "word long, mask long")
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    held = np.zeros(bits // 64, dtype=np.uint64)
    held[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return held


def shingle_sets(documents: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """``node, shingles``: the sorted distinct shingle hashes of ``wanted(node, row_a)`` and their digests.

    Rows are sorted out by a filter of their keys before anything is computed or shuffled. A few others
    pass it; the digests sort those out, and repeated rows count once.
    """
    shared = documents.sparkSession.sparkContext.broadcast(id_filter(wanted.select("row_a")))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = [batch.column(at).to_numpy(zero_copy_only=False) for at in range(2)]
            places = _places(keys[0], 64 * len(held))
            bit = (held[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
            passed = []
            for at in np.flatnonzero(bit.all(axis=1)):
                key = int(keys[0][at]), int(keys[1][at])
                if key not in seen:
                    seen.add(key)
                    passed.append(at)
            batch = batch.take(pa.array(passed, pa.int64()))
            for low, high in row_blocks(batch.column(2)):
                sets, first = distinct_sets(*shingle_hashes(batch.column(2).slice(low, high - low), words))
                lists = pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64))
                )
                digests = set_digests(sets, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests[0]), pa.array(digests[1]), pa.array(np.diff(first)), lists],
                    [*CLASS, "shingles"],
                )
        release_memory()

    schema = "set_a long, set_b long, n_shingles long, shingles array<long>"
    rows = keyed_rows(documents.select("doc_id", "text")).select("row_a", "row_b", "text")
    found = rows.mapInArrow(listed, schema).dropDuplicates(CLASS)
    return found.join(wanted.select("node", *CLASS), CLASS).select("node", "shingles")


def _relabelled(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``column`` replaced by its label, if it has one."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias("__label"))
    return rows.join(named, column, "left").withColumn(
        column, F.coalesce("__label", column)
    ).drop("__label").select(rows.columns)


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Merge the components of ``labels(node, label)`` along ``links(a, b)``.

    A node without a label is its own component; a component's label is its smallest node. Each round
    hooks every component to its smallest neighbour and shortens the chains by doubling, so the
    number of rounds grows with the logarithm of the longest chain. All tables stay distributed.
    """

    def between(edges: DataFrame, named: DataFrame) -> DataFrame:
        found = _relabelled(_relabelled(edges, "a", named), "b", named)
        return stage(found.where("a <> b").distinct(), "near-dup-edges")

    edges = between(links.select("a", "b"), labels)
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stage(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).where("label < node"),
            "near-dup-parents",
        )
        while True:
            above = parents.select(F.col("node").alias("label"), F.col("label").alias("above"))
            jumped = stage(parents.join(above, "label", "left"), "near-dup-parents")
            if jumped.where("above is not null").isEmpty():
                break
            parents = jumped.select("node", F.coalesce("above", "label").alias("label"))
        labels = stage(_relabelled(labels, "label", parents).unionByName(parents), "near-dup-labels")
        edges = between(edges, parents)
    return labels


def _differing(left: str, right: str) -> Column:
    counts = [
        F.bit_count(F.get(F.col(left), F.lit(at)).bitwiseXOR(F.get(F.col(right), F.lit(at))))
        for at in range(SKETCH_LONGS)
    ]
    return sum(counts[1:], counts[0])


def _first_shared_band() -> Column:
    """The number of the first band in which ``bands_a`` and ``bands_b`` are equal."""
    shared = [
        F.when(F.get("bands_a", F.lit(at)) == F.get("bands_b", F.lit(at)), F.lit(at)) for at in range(BANDS)
    ]
    return F.coalesce(*shared)


def verified(
    pairs: DataFrame, classes: DataFrame, documents: DataFrame, words: int, similarity: int
) -> DataFrame:
    """The pairs ``a, b`` whose full sets have 100 * common >= similarity * union.

    Only one document of each class in a pair is read again. The sets of a document in very many pairs meet them in
    a join that Spark splits.
    """
    pairs = stage(pairs.select("a", "b"), "near-dup-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stage(classes.select("node", "head.row_a", *CLASS).join(nodes, "node"), "near-dup-wanted")
    sets = stage(shingle_sets(documents, wanted, words), "near-dup-sets", BATCH_ROWS)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((common >= 1) & (100 * common >= similarity * union))
        .select("a", "b")
        .distinct()
    )


def _alike(pairs: DataFrame, sketches: DataFrame, most: int) -> DataFrame:
    """The pairs whose odd sketches differ in at most so many bits."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("left"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("right"))
    return pairs.join(left, "a").join(right, "b").where(_differing("left", "right") <= most).select("a", "b")


def components(
    documents: DataFrame, words: int = WORDS, similarity: int = SIMILARITY
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' signatures, ``set_a, set_b, n_shingles, label`` per class, and ``label, head`` per
    component.

    Links are between texts, whatever ids their rows have. ``head`` describes the row that stands for the
    component: the smallest by id, then by digest; rows without id come last.
    """
    documents = documents.select("doc_id", "text")
    signed = stage(signatures(documents, words), "near-dup-signatures", BATCH_ROWS)
    head = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", *CLASS, "row_a", "row_b")
    # bands and sketch follow from the set, so any row's will do; nodes go by id, since leaders are the
    # smallest nodes and an original tends to be older than its copies
    single = (
        signed.where("n_shingles > 0")
        .groupBy(*CLASS)
        .agg(F.min(head).alias("head"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .orderBy("head")
        .withColumn("node", F.monotonically_increasing_id())
    )
    single = stage(single, "near-dup-classes")
    buckets = single.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = (
        buckets.groupBy("bucket")
        .agg(F.min("node").alias("least"), F.max("node").alias("greatest"))
        .where("least < greatest")
    )
    members = stage(buckets.join(shared, "bucket"), "near-dup-buckets")
    sketches = single.select("node", "sketch")
    most = math.ceil(differing_bits(similarity / 100 - MARGIN))
    labels = single.select("node", F.col("node").alias("label")).where("false")

    # one leader for each document, then the leaders of all buckets that hold several components
    first = members.groupBy("node").agg(F.min("least").alias("leader")).where("node <> leader")
    links = _alike(first.select(F.col("leader").alias("a"), F.col("node").alias("b")), sketches, most)
    labels = connect(labels, verified(links, single, documents, words, similarity))
    for leader in ("least", "greatest"):
        labelled = _relabelled(members.withColumn("label", F.col("node")), "label", labels)
        led = _relabelled(labelled.withColumn("led", F.col(leader)), "led", labels)
        pairs = led.where("label <> led").select(
            F.least("node", leader).alias("a"), F.greatest("node", leader).alias("b")
        )
        links = verified(_alike(pairs.distinct(), sketches, most), single, documents, words, similarity)
        labels = connect(labels, links)

    labelled = _relabelled(members.withColumn("label", F.col("node")), "label", labels)
    labelled = stage(labelled.select("band", "bucket", "node", "label"), "near-dup-labelled")
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    rest = labelled.join(mixed, "bucket", "left_semi").join(
        single.select("node", "n_shingles", "bands", "sketch"), "node"
    )
    rest = stage(rest, "near-dup-mixed")

    def side(letter: str) -> DataFrame:
        names = ["node", "label", "n_shingles", "bands", "sketch"]
        own = {"node": letter} | {name: f"{name}_{letter}" for name in names[1:]}
        kept = ["band", "bucket"] if letter == "a" else ["bucket"]
        return rest.select(*kept, *[F.col(name).alias(own[name]) for name in names])

    # Sets whose sizes are further apart cannot be as similar, and a pair is taken in the first bucket
    # that it shares, which holds both labels and so is among these.
    small = F.least("n_shingles_a", "n_shingles_b") * 100
    across = side("a").join(side("b"), "bucket").where(
        (F.col("label_a") < F.col("label_b"))
        & (small >= similarity * F.greatest("n_shingles_a", "n_shingles_b"))
        & (_differing("sketch_a", "sketch_b") <= most)
        & (_first_shared_band() == F.col("band"))
    ).select("a", "b")
    labels = connect(labels, verified(across, single, documents, words, similarity))

    classes = single.select(*CLASS, "head", F.col("node").alias("label"))
    classes = stage(_relabelled(classes, "label", labels), "near-dup-components")
    heads = stage(classes.groupBy("label").agg(F.min("head").alias("head")), "near-dup-heads")
    return signed, classes.select(*CLASS, "label"), heads


def near_duplicates(
    documents: DataFrame, words: int = WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Texts are linked if their sets of ``words``-word shingles have a Jaccard similarity of at least
    ``similarity`` percent; ``component_id`` is the smallest ``doc_id`` that links lead to, null if
    none of them has an id. Null, empty and wordless texts are linked with nothing. Each row goes by its
    own text, also where rows share a ``doc_id`` or have none. Of a component the rows are kept that have
    its smallest id, and of several texts under this id (or without any) those of one. An empty table
    gives an empty table; other columns are ignored.
    """
    signed, classes, heads = components(documents, words, similarity)
    named = stage(classes.join(heads, "label"), "near-dup-named")
    linked = signed.where("n_shingles > 0").select("doc_id", *CLASS).join(named, CLASS).select(
        "doc_id",
        "n_shingles",
        F.col("head.doc_id").alias("component_id"),
        (
            F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
            & (F.col("set_a") == F.col("head.set_a"))
            & (F.col("set_b") == F.col("head.set_b"))
        ).alias("kept"),
    )
    alone = signed.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.unionByName(alone)


def drop_near_duplicates(documents: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest id.

    Wordless texts all stay, repeated rows of one id and text as one.
    """
    signed, _, heads = components(documents, words, similarity)
    wordless = signed.where("n_shingles = 0 and doc_id is not null").select("row_a", "row_b")
    kept = heads.select("head.row_a", "head.row_b").union(wordless.distinct())
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row")
    own = keyed_rows(documents.select(row, "doc_id", "text"))
    # without id and words there is nothing to tell rows apart by
    nameless = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    matched = own.where(~nameless).join(kept, ["row_a", "row_b"]).dropDuplicates(["row_a", "row_b"])
    return matched.select("row.*").unionByName(own.where(nameless).select("row.*"))
