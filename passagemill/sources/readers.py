"""Readers: binary files, tables, CSV files and CSV held in a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from passagemill.session import held_setting

#: Tasks for each core that list the folders of binary files.
LISTING_TASKS = 16


def read_binary_files(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Every file below ``path``: path, modificationTime, length, content.

    ``content`` is not read unless selected, and a filter on ``length`` reaches the listing. Many folders
    are listed by all cores, in a bounded number of tasks instead of one for each folder.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    with held_setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks):
        return reader.load(path)


def read_one_file(files: DataFrame, name: str | Column) -> DataFrame:
    """The file of the given name; with a column, of each row the one that is named there."""
    wanted = F.lit(name) if isinstance(name, str) else name
    return files.where(F.col("path").endswith(F.concat(F.lit("/"), wanted)))


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or a Parquet path if ``name`` holds a slash."""
    table = spark.read.parquet(name) if "/" in name else spark.table(name)
    return table if columns is None else table.select(*columns)


def read_csv_file(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame:
    """A CSV file with a header; fields may hold quoted commas and quotes.

    With ``multi_line`` they may hold line ends too, but then a file cannot be split over tasks.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def parse_csv_lines(df: DataFrame, line: str, schema: str) -> DataFrame:
    """Replace the column ``line`` by the fields of the CSV record it holds."""
    record: Column = F.from_csv(F.col(line), schema, {"escape": '"'})
    kept = [name for name in df.columns if name != line]
    return df.withColumn("_record", record).select(*kept, "_record.*")
