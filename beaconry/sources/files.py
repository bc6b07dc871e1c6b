"""Text lines with file name and row number, CSV manifest, directory listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per line: folder, file_name, row_num (1-based), line.

    Spark has no file row number, so a file is read as one value and split in
    place. Meant for transcript-sized files, one document each.
    """
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    lines = files.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder"),
                         F.col("_metadata.file_name").alias("file_name"),
                         F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("pos", "line"))
    return lines.select("folder", "file_name", (F.col("pos") + 1).cast("long").alias("row_num"), "line")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every landed file; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.col("length").alias("size"), F.col("modificationTime").alias("last_modified")))


def read_manifest(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Quoted CSV with a header. A value that doesn't fit its type stops the load.

    Lines with too few values are filled with NULL and surplus values are left
    out, unless ``strict``, which stops at the first such line.
    """
    kinds = StructType.fromDDL(schema)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if strict:
        return reader.schema(kinds).option("mode", "FAILFAST").csv(path)
    text = StructType([StructField(f.name, StringType()) for f in kinds])
    rows = reader.schema(text).option("mode", "PERMISSIVE").csv(path)

    def typed(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        fits = value.isNull() | value.try_cast(kind).isNotNull()
        wrong = F.raise_error(F.concat(F.lit(f"{name}: "), value, F.lit(f" is no {kind}")))
        return F.when(fits, value.try_cast(kind)).otherwise(wrong.cast(kind)).alias(name)

    return rows.select(*[typed(f.name, f.dataType.simpleString()) for f in kinds])


def write_manifest(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("quoteAll", True).csv(path))
