"""Counts per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, group: str, out: str = "row_count") -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias(out))


def count_rows(df: DataFrame, out: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def chart_top_groups(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The figures behind a bar chart: the n groups with the largest sums."""
    return (
        df.groupBy(group)
        .agg(F.count("*").alias("row_count"), F.round(F.sum(value), 2).alias("total"))
        .orderBy(F.col("total").desc(), F.col(group))
        .limit(n)
    )
