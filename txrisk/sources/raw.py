"""Raw transaction text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.schema import RAW

def read_raw(
    spark: SparkSession, path: str | list[str], glob: str | None = None, source_file: bool = False
) -> DataFrame:
    """Comma-separated transactions; lines starting with ``#`` are skipped.

    Values that do not fit the schema and missing trailing fields become null.
    ``glob`` filters file names; ``source_file`` adds the whole path of each row's file.
    """
    reader = spark.read.schema(RAW).option("comment", "#")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    return df.withColumn("source_file", F.col("_metadata.file_path")) if source_file else df


def raw_header(spark: SparkSession, path: str) -> list[str]:
    """Column names out of the ``# a | b | c`` line, where all files share one."""
    lines = spark.read.text(path).where(F.col("value").startswith("#")).distinct().limit(2).collect()
    if len(lines) != 1:
        raise ValueError(f"{'several' if lines else 'no'} header lines in {path}")
    return [name.strip() for name in lines[0]["value"].lstrip("#").split(" | ")]


def text_lines(source: DataFrame) -> DataFrame:
    """Lines of text files, batch or stream, with the file and the block of it that each comes from."""
    return source.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their 1-based number within each file, without a global sort."""
    return numbered(text_lines(spark.read.text(path)))


def numbered(lines: DataFrame) -> DataFrame:
    """``text_lines`` of whole files as ``file, line, value``.

    A line's number is its position in its file block plus the lines of the
    blocks before it; only one count per block is sorted.
    """
    lines = lines.withColumn("id", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return lines.join(offsets, ["file", "block"]).select(
        "file", (F.col("skip") + F.col("id") - F.col("first") + 1).alias("line"), "value"
    )


def file_headers(lines: DataFrame) -> DataFrame:
    """``file, names``: the column names of each file's first ``# a | b | c`` line, for files that have one."""
    first = lines.where(F.col("value").startswith("#")).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    names = F.transform(F.split(F.ltrim("header", F.lit("# ")), r" \| "), lambda name: F.trim(name))
    return first.select(F.col("file").alias("__of"), names.alias("names"))
