"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

Paragraphs are lines, cut after sentence ends and, where those are far apart, at words chosen by a
hash. Where a cut falls depends on the few words before it alone, so an edit changes the paragraphs around it
and no others.

Each paragraph's digest goes into three cells, one in each third of the sketch; a cell keeps the sum
of counts and the XOR of digests and of their checks. Two versions' sketches are subtracted cell by
cell: equal paragraphs vanish. A cell that holds a single digest gives it up, which frees others,
until nothing is left. If something is left, the sketch was too small, and a larger one is tried.

A sketch is an array of its cells in use, in the row of its document, so sums, subtraction and peeling are
column expressions and move nothing. Only the joins that bring each document the next one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.llm.common import let
from passagemill.session import stage

#: Where a line is cut: at a blank after these signs, and after these.
BLANK_ENDS = ".!?"
BARE_ENDS = "。！？"

#: After so many words without a sentence end, a line is cut behind one of so many words on average.
UNCUT_WORDS = 24
CUT_WORDS = 8

#: Cells in each third of a fingerprint.
THIRD = 8

#: A second try has this many cells in each third for each paragraph of both versions; each further one
#: has so many times more. Only cells in use are held, so a wide sketch is no larger than its entries, and
#: nearly every digest is alone in one of its cells and given up in the first round.
SECOND = 16
GROWTH = 3

#: A difference is tried with at most so many sizes. Each further one fails far more rarely than the one
#: before, so that the last is never met.
TRIES = 10

#: A cell's number and an entry's place in its array are held in one long.
PLACE_BITS = 31
PLACES = 1 << PLACE_BITS

#: A sketch's type.
CELLS = "array<struct<cell: bigint, n: bigint, key: bigint, check: bigint>>"

#: Rounds of giving up digests at most. What is left after them goes to the next try.
ROUNDS = 36


def _is_long(sentence: Column) -> Column:
    """Whether a sentence has more words than stay together: what is before so many blanks is less than it."""
    return F.substring_index(sentence, " ", UNCUT_WORDS) != sentence


def _stretches(sentence: Column) -> Column:
    """A sentence cut behind words that a hash of them and the word before chooses, and behind words that
    say the last one again."""

    def cut(words: Column) -> Column:
        def behind(at: Column) -> Column:
            last, before = F.get(words, at - 1), F.get(words, at - 2)
            return (last == before) | (F.pmod(F.xxhash64(last, before), F.lit(CUT_WORDS)) == 0)

        def pieces(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda start, number: F.array_join(
                    F.transform(
                        F.sequence(start, F.coalesce(F.get(starts, number + 1), F.size(words)) - 1),
                        lambda at: F.get(words, at),
                    ),
                    " ",
                ),
            )

        places = F.filter(F.sequence(F.lit(UNCUT_WORDS), F.size(words) - 1), behind)
        return let(F.concat(F.array(F.lit(0)), places), pieces)

    return F.when(_is_long(sentence), let(F.split(sentence, " ", -1), cut)).otherwise(
        F.array(sentence)
    )


def paragraphs(text: Column) -> Column:
    """The lines of a text, cut after sentence ends and long sentences at chosen words; without empty
    ones."""
    lines = text
    for sign in BLANK_ENDS:
        lines = F.replace(lines, F.lit(f"{sign} "), F.lit(f"{sign}\n"))
    for sign in BARE_ENDS:
        lines = F.replace(lines, F.lit(sign), F.lit(f"{sign}\n"))

    def cut(sentences: Column) -> Column:
        return F.when(
            F.exists(sentences, _is_long), F.flatten(F.transform(sentences, _stretches))
        ).otherwise(sentences)

    return F.filter(let(F.split(lines, "\n", -1), cut), lambda one: one != "")


def _runs(ordered: Column, value) -> Column:
    """Begin and length of each run of equal ``value`` in a sorted array."""

    def bounded(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, at: F.struct(
                start.alias("begin"),
                (F.coalesce(F.get(starts, at + 1), F.size(ordered)) - start).alias("length"),
            ),
        )

    places = F.filter(
        F.transform(
            ordered,
            lambda one, at: F.when(
                (at == 0) | (value(one) != value(F.get(ordered, at - 1))), at
            ),
        ),
        lambda at: at.isNotNull(),
    )
    return let(places, bounded)


def paragraph_keys(text: Column) -> Column:
    """A digest for each paragraph; repeated ones are told apart by how often they came before."""

    def numbered(ordered: Column) -> Column:
        return F.flatten(
            F.transform(
                _runs(ordered, lambda one: one),
                lambda run: F.transform(
                    F.sequence(F.lit(1), run["length"]),
                    lambda time: F.xxhash64(F.get(ordered, run["begin"]), time),
                ),
            )
        )

    def keys(ordered: Column) -> Column:
        once = F.transform(ordered, lambda one: F.xxhash64(one, F.lit(1)))
        differ = F.size(F.array_distinct(ordered)) == F.size(ordered)
        return F.when(differ, once).otherwise(numbered(ordered))

    digests = F.transform(paragraphs(F.coalesce(text, F.lit(""))), lambda one: F.xxhash64(one))
    return let(F.sort_array(digests), keys)


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _entries(n: Column, key: Column, check: Column, third: Column) -> Column:
    """What a key adds to a sketch: one entry in each third."""

    def entry(part: int) -> Column:
        cell = third * part + F.pmod(F.xxhash64(key, F.lit(part), third), third)
        return F.struct(
            cell.alias("cell"), n.alias("n"), key.alias("key"), check.alias("check")
        )

    return F.array(*[entry(part) for part in range(3)])


def _is_zero(entry: Column) -> Column:
    return (entry["n"] == 0) & (entry["key"] == 0) & (entry["check"] == 0)


def _cells(entries: Column) -> Column:
    """Entries of one cell added up, in the order of cells; cells that come to nothing are left out.

    Numbers are sorted and not entries, which are far slower to compare: cell and place of each entry."""

    def entry_at(entries: Column, number: Column) -> Column:
        return F.get(entries, number.bitwiseAND(F.lit(PLACES - 1)).cast("int"))

    def add(total: Column, one: Column) -> Column:
        return F.struct(
            one["cell"].alias("cell"),
            (total["n"] + one["n"]).alias("n"),
            total["key"].bitwiseXOR(one["key"]).alias("key"),
            total["check"].bitwiseXOR(one["check"]).alias("check"),
        )

    def summed(bound: Column) -> Column:
        entries, ordered = bound["entries"], bound["ordered"]
        sums = F.transform(
            _runs(ordered, lambda number: F.shiftright(number, PLACE_BITS)),
            lambda run: F.when(
                run["length"] == 1, entry_at(entries, F.get(ordered, run["begin"]))
            ).otherwise(
                F.aggregate(
                    F.sequence(run["begin"] + 1, run["begin"] + run["length"] - 1),
                    entry_at(entries, F.get(ordered, run["begin"])),
                    lambda total, at: add(total, entry_at(entries, F.get(ordered, at))),
                )
            ),
        )
        return F.filter(sums, lambda one: ~_is_zero(one))

    def sorted_(entries: Column) -> Column:
        numbers = F.transform(entries, lambda one, at: F.shiftleft(one["cell"], PLACE_BITS) + at)
        return let(
            F.struct(entries.alias("entries"), F.sort_array(numbers).alias("ordered")), summed
        )

    return let(entries, sorted_)


def _summed(keys: Column, third: Column, left: Column | None = None) -> Column:
    """The cells in use of the sketch of some keys, or of the first ``left`` keys minus that of the others.

    Like ``_cells`` of all entries, but an entry is only its cell's number and its key's place, in one
    long, until the entries of a cell are added up; the check of a key is computed once.
    """

    def number(key: Column, at: Column, part: int) -> Column:
        cell = third * part + F.pmod(F.xxhash64(key, F.lit(part), third), third)
        return F.shiftleft(cell, PLACE_BITS) + at

    def signed(key: Column, at: Column) -> Column:
        n = F.lit(1).cast("long")
        if left is not None:
            n = F.when(at < left, n).otherwise(-n)
        return F.struct(n.alias("n"), key.alias("key"), _check(key).alias("check"))

    def total(signed: Column, ordered: Column, starts: Column) -> Column:
        def at(number: Column) -> Column:
            return F.get(signed, number.bitwiseAND(F.lit(PLACES - 1)).cast("int"))

        def cell(first: Column, n: Column, key: Column, check: Column) -> Column:
            number = F.shiftright(first, PLACE_BITS)
            return F.struct(number.alias("cell"), n.alias("n"), key.alias("key"), check.alias("check"))

        def alone(first: Column) -> Column:
            return let(at(first), lambda one: cell(first, one["n"], one["key"], one["check"]))

        def two(first: Column, second: Column) -> Column:
            def both(held: Column) -> Column:
                one, other = held["one"], held["other"]
                sum_ = cell(
                    first,
                    one["n"] + other["n"],
                    one["key"].bitwiseXOR(other["key"]),
                    one["check"].bitwiseXOR(other["check"]),
                )
                # a key of both versions vanishes
                gone = (one["key"] == other["key"]) & (one["n"] != other["n"])
                return F.when(~gone, sum_)

            return let(F.struct(at(first).alias("one"), at(second).alias("other")), both)

        def several(first: Column, numbers: Column) -> Column:
            zero = F.lit(0).cast("long")
            n = F.size(numbers).cast("long")
            return let(
                F.transform(numbers, at),
                lambda held: cell(
                    first,
                    n if left is None else F.aggregate(held, zero, lambda sum_, one: sum_ + one["n"]),
                    F.aggregate(held, zero, lambda sum_, one: sum_.bitwiseXOR(one["key"])),
                    F.aggregate(held, zero, lambda sum_, one: sum_.bitwiseXOR(one["check"])),
                ),
            )

        def sum_of(start: Column, run: Column) -> Column:
            first = F.get(ordered, start)
            size = F.coalesce(F.get(starts, run + 1), F.size(ordered)) - start
            return (
                F.when(size == 1, alone(first))
                .when(size == 2, two(first, F.get(ordered, start + 1)))
                .otherwise(several(first, F.slice(ordered, start + 1, size)))
            )

        return F.filter(
            F.transform(starts, sum_of), lambda one: one.isNotNull() & ~_is_zero(one)
        )

    def starts(ordered: Column) -> Column:
        """Where a cell's entries begin; there are three entries or more."""

        def differs(at: Column) -> Column:
            return F.get(ordered, at).bitwiseXOR(F.get(ordered, at - 1)) >= PLACES

        return F.concat(F.array(F.lit(0)), F.filter(F.sequence(F.lit(1), F.size(ordered) - 1), differs))

    def added(keys: Column) -> Column:
        numbers = F.flatten(
            F.transform(keys, lambda key, at: F.array(*[number(key, at, part) for part in range(3)]))
        )
        sums = let(
            F.transform(keys, signed),
            lambda signed: let(
                F.sort_array(numbers),
                lambda ordered: let(starts(ordered), lambda starts: total(signed, ordered, starts)),
            ),
        )
        return F.when(F.size(keys) == 0, F.array().cast(CELLS)).otherwise(sums)

    return let(keys, added)


def sketch(keys: Column, third: Column) -> Column:
    """The cells in use of the sketch of some keys, with so many cells in each third."""
    return _summed(keys, third)


def subtract(left: Column, right: Column) -> Column:
    """The cells of ``left`` minus those of ``right``, both of one size."""

    def negative(cell: Column) -> Column:
        return F.struct(cell["cell"], (-cell["n"]).alias("n"), cell["key"], cell["check"])

    return _cells(F.concat(left, F.transform(right, negative)))


def _difference(left: Column, right: Column, third: Column) -> Column:
    """``subtract`` of the sketches of two key arrays, all entries added up at once."""
    return _summed(F.concat(left, right), third, F.size(left))


def peel(cells: Column, third: Column) -> Column:
    """``cells`` that are left and ``recovered`` digests: ``found``, and ``n``, which is 1 for the left
    version and -1 for the right; with ``third``.

    A round gives up the digests of all cells that hold a single one, each digest once, however many
    of its cells do. Rounds end when nothing is left or nothing was given up. Each digest is in three
    cells, so all cells' digests and checks come to the XOR of what they hold: if that is what was given
    up, nothing is left, and the cells need not be added up once more.
    """

    def state(cells: Column, recovered: Column, stuck: Column) -> Column:
        return F.struct(
            cells.alias("cells"), recovered.alias("recovered"), stuck.alias("stuck"), third.alias("third")
        )

    def pure(cells: Column, sign: int) -> Column:
        held = F.filter(
            cells, lambda cell: (cell["n"] == sign) & (cell["check"] == _check(cell["key"]))
        )
        keys = F.transform(held, lambda cell: cell["key"])
        n = F.lit(sign).cast("long")
        return F.transform(
            F.array_distinct(keys), lambda key: F.struct(key.alias("found"), n.alias("n"))
        )

    def all_of(values: Column, value) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(values, zero, lambda sum_, one: sum_.bitwiseXOR(value(one)))

    def account_for(given: Column, cells: Column) -> Column:
        return (
            all_of(given, lambda one: one["found"]) == all_of(cells, lambda cell: cell["key"])
        ) & (
            all_of(given, lambda one: _check(one["found"])) == all_of(cells, lambda cell: cell["check"])
        )

    def round_of(before: Column, number: Column) -> Column:
        def given_up(given: Column) -> Column:
            taken = F.transform(
                given, lambda one: _entries(-one["n"], one["found"], _check(one["found"]), third)
            )
            return F.when(
                F.size(given) == 0, state(before["cells"], before["recovered"], F.lit(True))
            ).when(
                account_for(given, before["cells"]),
                state(nothing, F.concat(before["recovered"], given), F.lit(False)),
            ).otherwise(
                state(
                    _cells(F.concat(before["cells"], F.flatten(taken))),
                    F.concat(before["recovered"], given),
                    F.lit(False),
                )
            )

        found = F.concat(pure(before["cells"], 1), pure(before["cells"], -1))
        done = before["stuck"] | (F.size(before["cells"]) == 0)
        return F.when(done, before).otherwise(let(found, given_up))

    nothing = F.array().cast(CELLS)
    none = F.array().cast("array<struct<found: bigint, n: bigint>>")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), state(cells, none, F.lit(False)), round_of
    )


def recovered(a: Column, b: Column, first: Column, third: int = THIRD) -> Column:
    """``third, solved, digests`` of the difference of two key arrays.

    ``first`` is the difference of their sketches with ``third`` cells in each third. If that does not
    peel to nothing, larger sketches are made of the keys until one does.
    """

    second = F.ceil((F.size(a) + F.size(b)) * F.lit(SECOND))
    larger = F.greatest(F.lit(third * GROWTH), second).cast("long")

    def again(before: Column, size: Column) -> Column:
        return F.when(F.size(before["cells"]) == 0, before).otherwise(peel(_difference(a, b, size), size))

    def answer(peeled: Column) -> Column:
        return F.struct(
            peeled["third"].alias("third"),
            (F.size(peeled["cells"]) == 0).alias("solved"),
            peeled["recovered"].alias("digests"),
        )

    return F.aggregate(
        F.array(*[larger * GROWTH**at for at in range(TRIES - 1)]),
        peel(first, F.lit(third).cast("long")),
        again,
        answer,
    )


def _solved(found: Column) -> Column:
    """The digests; a difference that no try solved is an error and never a guess."""
    return F.when(found["solved"], found["digests"]).otherwise(
        F.raise_error(F.lit("a difference of fingerprints was not recovered")).cast(
            "array<struct<found: bigint, n: bigint>>"
        )
    )


def difference(pairs: DataFrame, third: int = THIRD) -> DataFrame:
    """Compare the key arrays ``a`` and ``b`` of ``pairs(pair, a, b)`` by their sketches alone.

    Returns ``pair, third, found, n`` for each recovered digest, ``n`` 1 if only ``a`` has it and -1 if
    only ``b`` has it; ``third`` is the size that gave the answer. A pair without a difference has no row.
    """
    size = F.lit(third).cast("long")
    first = subtract(sketch(F.col("a"), size), sketch(F.col("b"), size))
    found = pairs.select("pair", recovered(F.col("a"), F.col("b"), first, third).alias("answer"))
    return found.select("pair", "answer.third", F.inline(_solved(F.col("answer"))))


def likeness(n_a: Column, n_b: Column, only_a: Column, only_b: Column) -> Column:
    """Shared paragraphs over all paragraphs, from the sizes and the recovered difference; texts
    without paragraphs are wholly like each other."""
    union = n_b + only_a
    return F.when(union == 0, F.lit(1.0)).otherwise((n_a - only_a).cast("double") / union)


def written(cells: Column) -> Column:
    """A sketch as text: number, count, digest and check of each cell in use, the last two in
    hexadecimal. Without paragraphs it is empty."""
    return F.array_join(
        F.transform(
            cells,
            lambda one: F.concat_ws(
                ":",
                one["cell"].cast("string"),
                one["n"].cast("string"),
                F.hex(one["key"]),
                F.hex(one["check"]),
            ),
        ),
        ";",
    )


def next_ids(documents: DataFrame) -> DataFrame:
    """``doc_id, next_id, n_chars``: the next smaller id, and the largest after the smallest.

    Ids are dealt by ranges; each range finds its own neighbours, and the ranges' first ids close the
    gaps between them. No task sees all ids.
    """
    ids = (
        documents.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.length("text")).alias("n_chars"))
    )
    falling = F.col("doc_id").desc()
    ranges = stage(
        ids.repartitionByRange(falling).withColumn("part", F.spark_partition_id()), "fingerprint-ids"
    )
    # one row per range
    heads = ranges.groupBy("part").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy("part")
    first = F.max("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("part", F.coalesce(F.lead("head").over(order), first).alias("after"))
    own = F.lead("doc_id").over(Window.partitionBy("part").orderBy(falling))
    return (
        ranges.withColumn("own", own)
        .join(after, "part")
        .select("doc_id", F.coalesce("own", "after").alias("next_id"), "n_chars")
    )


def edited_versions(documents: DataFrame) -> DataFrame:
    """Per row: ``doc_id, text, edited, next_keys``.

    ``edited`` is the text with its last third replaced by the beginning of the next document, which
    is cut out before it travels. If several rows have the next id, the smallest beginning is taken.
    A row without id has no next document: nothing takes the place of its last third.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    nameless = rows.where("doc_id is null")
    rows = rows.where("doc_id is not null")
    following = stage(next_ids(rows), "fingerprint-next")
    wanted = following.select(
        F.col("doc_id").alias("to_id"), F.col("next_id").alias("doc_id"), "n_chars"
    )
    # both joins deal the texts by id, so Spark deals them once
    given = (
        rows.join(wanted.hint("merge"), "doc_id")
        .select(
            "to_id",
            F.expr("substring(text, 1, cast(floor(n_chars / 3) as int))").alias("start"),
            paragraph_keys(F.col("text")).alias("next_keys"),
        )
        .groupBy(F.col("to_id").alias("doc_id"))
        .agg(F.min(F.struct("start", "next_keys")).alias("given"))
        .select("doc_id", "given.*")
    )
    cut = "cast(floor(length(text) / 3) as int)"
    edited = F.concat(
        F.expr(f"substring(text, 1, length(text) - {cut})"),
        F.expr(f"coalesce(substring(start, 1, {cut}), '')"),
    )
    both = rows.join(given.hint("merge"), "doc_id")
    alone = nameless.select(
        "*", F.lit("").alias("start"), F.array().cast("array<bigint>").alias("next_keys")
    )
    return both.unionByName(alone).select("doc_id", "text", edited.alias("edited"), "next_keys")


def compare_versions(versions: DataFrame, third: int = THIRD) -> DataFrame:
    """Fingerprints and likenesses of ``doc_id, text, edited, next_keys``.

    Each version's sketch is made once in its row; the printed one and the subtracted one are the same.
    Empty texts have an empty fingerprint and are wholly like each other. Repeated rows are compared
    each; an empty table gives an empty table.
    """
    size = F.lit(third).cast("long")
    keyed = versions.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_keys(F.col("text")).alias("own"),
        paragraph_keys(F.col("edited")).alias("edited"),
        F.col("next_keys").alias("next"),
    )
    sides = ("own", "edited", "next")
    sketched = keyed.select("*", *[sketch(F.col(name), size).alias(f"{name}_cells") for name in sides])

    def near(name: str) -> Column:
        first = subtract(F.col("own_cells"), F.col(f"{name}_cells"))

        def share(digests: Column) -> Column:
            only_a = F.size(F.filter(digests, lambda one: one["n"] == 1))
            only_b = F.size(digests) - only_a
            return likeness(F.size("own"), F.size(name), only_a, only_b)

        answer = recovered(F.col("own"), F.col(name), first, third)
        return let(let(answer, _solved), share)

    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own_cells")).alias("fingerprint"),
        written(F.col("edited_cells")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
