"""Column helpers for text. All of them stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns below are also used by the checking SQL, so they stay in the subset
# that Java and RE2 share.
TERM_PATTERN = r"[\p{L}\p{N}]+"
BLANKS = r"[ \t\n\x0B\f\r]+"
BLANKS_IN_LINE = r"[ \t\x0B\f\r]+"
SENTENCE_END = r"([.!?]) "
EDGE_BLANKS = " \t\x0b\f\r\n"
HTML_DROPPED = [
    r"(?s)<!--.*?-->",
    r"(?is)<script\b.*?</script>",
    r"(?is)<style\b.*?</style>",
]
# The elements of a page that begin and end a line.
BLOCK_TAGS = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre section select summary table tbody td tfoot th thead title tr ul"
).split()
HTML_BREAK = rf"(?i)</?({'|'.join(BLOCK_TAGS)})\b[^>]*>"
HTML_TAG = r"(?s)<[^>]*>"
HTML_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column that is read inside a lambda is otherwise inlined there by the optimizer and
    evaluated again for every array element.
    """
    return F.transform(F.array(value), body)[0]


def tokens(text: Column) -> Column:
    """Blank-separated tokens, the unit in which chunks are measured."""
    return F.filter(F.split(text, BLANKS), lambda token: token != "")


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def terms(text: Column) -> Column:
    """Lower-cased search terms."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGE_BLANKS))


def nonempty(elements: Column) -> Column:
    return F.filter(elements, lambda element: element != "")


def sentences(text: Column) -> Column:
    """Sentences in order, with single blanks between their tokens and without blank ones.

    A sentence ends at a line end, or at an end mark followed by a blank; so tokens such as 3.14
    stay whole, and every token of the text is in exactly one sentence.
    """
    line_by_line = F.regexp_replace(text, BLANKS_IN_LINE, " ")
    marked = F.regexp_replace(line_by_line, SENTENCE_END, "$1\n")
    return nonempty(F.transform(F.split(marked, "\n"), lambda part: F.btrim(part)))


def words(sentence: Column) -> Column:
    """Tokens of one of ``sentences``, where single blanks separate them."""
    return F.split(sentence, " ")


def _entity(name: Column) -> Column:
    """The sign that a character reference stands for; an unknown one stays as it is written."""
    signs = {name: chr(code) for name, code in name2codepoint.items()}
    signs |= {"apos": "'", "nbsp": " "}
    named = F.create_map(
        *[F.lit(part) for name, sign in signs.items() for part in (name, sign)],
    )
    written = F.concat(F.lit("&"), name, F.lit(";"))
    number = F.when(
        F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 6), 16, 10)
    ).otherwise(F.substring(name, 2, 7)).cast("int")
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    sign = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(
        F.startswith(name, F.lit("#")), F.when(valid, sign).otherwise(written)
    ).otherwise(F.coalesce(F.try_element_at(named, name), written))


def decoded(text: Column) -> Column:
    """``text`` with each character reference replaced once."""

    def joined(parts: Column, names: Column) -> Column:
        signs = F.transform(names, _entity)
        return F.array_join(
            F.zip_with(parts, signs, lambda part, sign: F.concat(part, F.coalesce(sign, F.lit("")))),
            "",
        )

    names = F.regexp_extract_all(text, F.lit(HTML_ENTITY), F.lit(1))
    plain = F.instr(text, "&") == 0
    return F.when(plain, text).otherwise(joined(F.split(text, HTML_ENTITY, -1), names))


def html_elements(html: Column) -> Column:
    """Texts of the layout elements of a page, in order, without empty ones."""
    for pattern in HTML_DROPPED:
        html = F.regexp_replace(html, pattern, "")
    # Line ends inside the source are layout, not content; only block tags separate elements.
    html = F.regexp_replace(html, r"\s+", " ")
    html = F.regexp_replace(html, HTML_BREAK, "\n")
    html = F.regexp_replace(html, HTML_TAG, "")
    lines = F.transform(F.split(html, "\n"), lambda line: trimmed(decoded(line)))
    return nonempty(lines)


def plain_elements(text: Column) -> Column:
    return nonempty(F.transform(F.split(text, "\n"), trimmed))


def join_lines(elements: Column) -> Column:
    return F.array_join(elements, "\n")


def clean_code(text: Column) -> Column:
    """Strip blanks and backticks around a code reply, and a leading language word."""
    text = F.regexp_replace(text, r"^[\s`]+|[\s`]+$", "")
    return F.regexp_replace(text, r"^python\s*", "")


def without(text: Column, literal: str) -> Column:
    return F.replace(text, F.lit(literal), F.lit(""))


def truncated(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def first_tokens(text: Column, limit: int) -> Column:
    return F.array_join(F.slice(tokens(text), 1, limit), " ")


SLOT = re.compile(r"\{(\w+)\}")


def template_slots(template: str) -> list[str]:
    return SLOT.findall(template)


def filled(template: str, slots: Mapping[str, Column]) -> Column:
    """The template with every ``{slot}`` replaced by its column; a null fills in as empty.

    The pieces are concatenated, so a slot name that happens to occur inside a value stays as it is.
    """
    missing = [name for name in template_slots(template) if name not in slots]
    if missing:
        raise ValueError(f"template slots without a column: {missing}")
    pieces = SLOT.split(template)
    parts = [
        F.coalesce(slots[piece].cast("string"), F.lit("")) if at % 2 else F.lit(piece)
        for at, piece in enumerate(pieces)
    ]
    return F.concat(*parts)


def fill_template(df: DataFrame, template: str, out: str = "prompt", **slots: str) -> DataFrame:
    """Add the filled template. Slots take the column of their own name unless given otherwise."""
    names = {name: slots.get(name, name) for name in template_slots(template)}
    absent = [column for column in names.values() if column not in df.columns]
    if absent:
        raise ValueError(f"template slots without a column: {absent}")
    return df.withColumn(out, filled(template, {name: F.col(c) for name, c in names.items()}))
