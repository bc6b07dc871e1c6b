"""Table writes without an ACID format: each change goes to a new path or version.

A reader of the old path is never disturbed, and a failed job leaves it intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> DataFrame:
    """Write (or overwrite) and read back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_rows(df: DataFrame, condition: Column, new_path: str) -> DataFrame:
    """Keep every row the condition does not hold for (NULL keeps the row)."""
    return replace_table(df.filter(~F.coalesce(condition, F.lit(False))), new_path)


def write_version(df: DataFrame, root: str, version: str) -> DataFrame:
    """Immutable version: created once, an existing one is loaded unchanged."""
    path = f"{root}/version={version}"
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception as error:
        if "PATH_ALREADY_EXISTS" not in str(error):
            raise
    return load_version(df.sparkSession, root, version)


def load_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version}")


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace the catalog table ``name`` with the rows, stored at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
