"""Properties and folders of tables in the session catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGE_FEED = "passagemill.changeFeed"


def set_change_feed(spark: SparkSession, name: str, on: bool = True) -> None:
    set_property(spark, name, CHANGE_FEED, str(on).lower())


def has_change_feed(spark: SparkSession, name: str) -> bool:
    return get_property(spark, name, CHANGE_FEED) == "true"


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{quoted}')")


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    """The value of a table property, none if it is not set."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).first()
    return None if found is None else found["value"]


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def new_version_folder(spark: SparkSession, name: str) -> str:
    """A folder for new rows below the table's first one. Folders that begin with an underscore are no
    part of the table above them."""
    root = location(spark, name).split("/_version-")[0]
    return f"{root}/_version-{uuid.uuid4().hex}"


def write_version(rows: DataFrame, name: str, path: str) -> None:
    """Write rows for the table to a folder, with its columns that they lack as nulls."""
    held = rows.sparkSession.table(name).schema
    missing = {f.name: F.lit(None).cast(f.dataType) for f in held.fields if f.name not in rows.columns}
    rows.withColumns(missing).write.parquet(path)


def point_at(spark: SparkSession, name: str, path: str) -> None:
    """Make the rows of a folder those of the table, and add the columns that it lacks."""
    held = spark.table(name).schema.names
    added = [field for field in spark.read.parquet(path).schema.fields if field.name not in held]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
