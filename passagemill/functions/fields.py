"""Column helpers for replies and status fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_present(*fields: Column, default: str) -> Column:
    return F.coalesce(*fields, F.lit(default))


def state_by_word(state: Column, words: Mapping[str, str], otherwise: str) -> Column:
    """The value of the first word that the upper-cased state contains."""
    result = F.lit(otherwise)
    for word, value in reversed(list(words.items())):
        result = F.when(F.upper(state).contains(word), value).otherwise(result)
    return result


def reply_field(reply: Column, name: str) -> Column:
    """One field of a reply held as JSON text."""
    return F.get_json_object(reply, f"$.{name}")


def vector_head(vector: Column, n: int = 20) -> Column:
    return F.slice(vector, 1, n)
