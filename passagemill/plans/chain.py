"""Staged chains over a table of inputs: the keys of a chain's record are columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

Stage = Callable[[DataFrame], DataFrame]


def stage_pipe(*stages: Stage) -> Stage:
    """The stages one after the other, as one stage."""

    def run(df: DataFrame) -> DataFrame:
        for each in stages:
            df = df.transform(each)
        return df

    return run


def stage_map(key: str, **stages: Column | Stage) -> Stage:
    """Stages side by side on the same input. The result holds the row key and the stages' names.

    Column stages become one projection. A stage that is a function returns (key, one column) and
    is joined on the row key.
    """

    def run(df: DataFrame) -> DataFrame:
        columns = {n: s for n, s in stages.items() if isinstance(s, Column)}
        out = df.select(key, *[column.alias(name) for name, column in columns.items()])
        for name, each in stages.items():
            if name not in columns:
                part = df.transform(each)
                value = next(c for c in part.columns if c != key)
                out = out.join(part.select(key, part[value].alias(name)), key, "left")
        return out.select(key, *stages)

    return run


def stage_assign(**stages: Column) -> Stage:
    """Add or replace columns, keep the others. All stages see the input's columns."""

    def run(df: DataFrame) -> DataFrame:
        return df.withColumns(dict(stages))

    return run

