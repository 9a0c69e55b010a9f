"""Bytes to text. HTML and plain text are native; other formats take a user's parser."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.functions.text import (
    html_elements,
    join_lines,
    nonempty,
    plain_elements,
)

_ELEMENTS = {"html": html_elements, "plain": plain_elements}


def extract_text(
    df: DataFrame, content: str = "content", kind: str = "html", out: str = "text"
) -> DataFrame:
    """Replace the bytes column by the non-empty element texts joined by line ends.

    Bytes that are no UTF-8 become replacement signs; they never fail a file.
    """
    text = F.col(content)
    if _is_binary(df, content):
        text = F.make_valid_utf8(text.cast("string"))
    kept = [name for name in df.columns if name not in (content, out)]
    return df.select(*kept, join_lines(_ELEMENTS[kind](text)).alias(out))


def _is_binary(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] == "binary"


def extract_with(
    df: DataFrame,
    make_parser: Callable[[], Callable[[bytes], list[str]]],
    content: str = "content",
    out: str = "text",
) -> DataFrame:
    """Like ``extract_text`` for a parser that lists a file's element texts.

    The parser is built once per task. Files can be large: run the stage that evaluates this with a
    small Arrow batch (``stage(df, label, arrow_rows=10)``).
    """

    @F.pandas_udf("array<string>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        parser = make_parser()
        for files in batches:
            yield files.map(lambda data: None if data is None else list(parser(data)))

    kept = [name for name in df.columns if name not in (content, out)]
    elements = parse.asNondeterministic()(F.col(content))
    parsed = df.select(*kept, elements.alias("_elements"))
    return parsed.select(*kept, join_lines(nonempty(F.col("_elements"))).alias(out))
