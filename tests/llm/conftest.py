import random

import pytest

#: Names that operators use inside or return.
CLASHING = (
    "row score predicted features probability quality n_tokens n_words kept slot slot_part part shard "
    "grown_shard grid rate copies words hashed ids begin sequence_id node label bands sketch text_crc32"
).split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    stock = "the of and to in a is that it for on was be with river stone house light garden".split()
    out = [draw.choice(stock) + (draw.choice(["", "", "s", "ing"])) for _ in range(words)]
    lines = [" ".join(out[at : at + 12]) + "." for at in range(0, words, 12)]
    return "\n".join(lines)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, a very long one, ties, repeated rows, odd signs."""
    long_text = prose(1, 120_000)
    texts = {
        1: prose(2, 80),
        2: prose(2, 80),
        3: None,
        4: "",
        5: " \t\n\x0b ",
        6: "word",
        7: "Two words",
        8: long_text,
        9: long_text + " and one more line at the end",
        10: "Été ÑANDÚ   x y <|endoftext|> \U0001f600 don't it's 12½ á",
        11: "x" * 50_000,
        12: "\x1c\x1d a\x85b '' ## && 7 7 7",
        13: prose(3, 60).upper(),
    }
    rows = [(key, text) for key, text in texts.items()]
    return rows + [(1, texts[1]), (None, texts[1]), (None, None), (None, "nameless")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with further columns under clashing names, null in part."""
    full = [
        (key, text, None if key is None else "en", None, 0, *(None if at % 2 else f"own {at}" for at in range(len(CLASHING))))
        for key, text in edge_rows
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{name}` string" for name in CLASHING
    )
    return spark.createDataFrame(full, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
